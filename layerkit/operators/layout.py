"""Physical layout: clustering rewrite, clustering report, bloom-filter point-lookup aid.

Clustering = range-partition on the key + sort within partitions before writing, so each
file covers a narrow, mostly disjoint key range and Parquet min/max statistics let a filter
skip files and row groups. The report is computed from the files' own key ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SWEEP_PARTS = 16        # ranges of endpoints that are swept side by side

def cluster_by(df: DataFrame, path: str, keys: list[str], num_files: int | None = None,
               bloom_columns: list[str] | None = None, mode: str = "overwrite") -> None:
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode(mode)
    for c in bloom_columns or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def write_with_bloom(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """``add search optimization on equality(c)``: Parquet bloom filters on the given columns."""
    w = df.write.mode(mode)
    for c in columns:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def file_key_ranges(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per data file (known by its path): its key range and row count (a grouped scan of ``_metadata``)."""
    df = spark.read.parquet(path)
    return (df.select(F.col("_metadata.file_path").alias("file_name"), F.col(key).alias("k"))
            .groupBy("file_name")
            .agg(F.min("k").alias("min_key"), F.max("k").alias("max_key"), F.count(F.lit(1)).alias("rows")))


def sweep(ranges: DataFrame, parts: int = SWEEP_PARTS) -> DataFrame:
    """Per file of ``ranges`` (file_name, min_key, max_key): depth where it starts, and the number of other files whose range
    meets its own.

    The endpoints are swept in key order (a start counts before an end at the same key, ranges are closed). They are
    range-partitioned into ``parts``; the starts and ends of each part are counted, the counts before a part are summed over
    these few rows, and the running counts are taken inside the parts: no task sees all files."""
    spark = ranges.sparkSession
    listed = scratch_path(spark, "ranges")
    ranges.select("file_name", "min_key", "max_key").write.parquet(listed)     # the files are read once
    ranges = spark.read.parquet(listed)
    ev = (ranges.select("file_name", F.col("min_key").alias("pos"), F.lit(0).alias("o"))
          .unionByName(ranges.select("file_name", F.col("max_key").alias("pos"), F.lit(1).alias("o"))))
    path = scratch_path(spark, "sweep")
    ev.repartitionByRange(parts, "pos", "o", "file_name").withColumn("part", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)                     # the part numbers are data from here on
    counts = placed.groupBy("part").agg(F.sum(1 - F.col("o")).alias("starts"), F.sum("o").alias("ends"))
    starts = ends = 0
    before = []
    for part, s, e in sorted(tuple(r) for r in counts.collect()):      # at most ``parts`` rows
        before.append((part, starts, ends))
        starts, ends = starts + s, ends + e
    offsets = spark.createDataFrame(before, "part int, starts_before long, ends_before long")
    w = Window.partitionBy("part").orderBy("pos", "o", "file_name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = placed.join(F.broadcast(offsets), "part").select(
        "file_name", "pos", "o", (F.sum(1 - F.col("o")).over(w) + F.col("starts_before")).alias("starts"), (F.sum("o").over(w) + F.col("ends_before")).alias("ends"))
    per_file = swept.groupBy("file_name").agg(
        F.max(F.when(F.col("o") == 1, F.col("starts"))).alias("starts_to_end"),
        F.max(F.when(F.col("o") == 0, F.col("ends"))).alias("ends_before_start"),
        F.max(F.when(F.col("o") == 0, F.col("starts") - F.col("ends"))).alias("depth"),
        F.max(F.when(F.col("o") == 0, F.col("pos"))).alias("min_key"),
        F.max(F.when(F.col("o") == 1, F.col("pos"))).alias("max_key"))
    return per_file.select("file_name", "min_key", "max_key", "depth", (F.col("starts_to_end") - F.col("ends_before_start") - 1).alias("overlaps"))


def layout_report(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``clustering_information``: files, constant files, average overlaps, average and max depth."""
    return sweep(file_key_ranges(spark, path, key)).agg(
        F.count(F.lit(1)).alias("total_files"), F.count(F.when(F.col("min_key") == F.col("max_key"), 1)).alias("constant_files"),
        F.avg("overlaps").alias("average_overlaps"), F.avg("depth").alias("average_depth"), F.max("depth").alias("max_depth"))


def depth_histogram(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Number of files by the depth where they start."""
    return sweep(file_key_ranges(spark, path, key)).groupBy("depth").agg(F.count(F.lit(1)).alias("files"))

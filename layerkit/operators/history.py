"""Validity intervals (type-2 history): ``valid_to = nvl(lead(valid_from) over (partition by key
order by valid_from), '9999-12-31')`` and current-row selection.

A per-key window would put every version of a key into one task. Instead the rows are
range-partitioned on (key, valid_from, tie...), so a hot key lies in several partitions, and
``lead`` is taken per (partition, key). Only the last row of a key in a partition is left: it takes the
first ``valid_from`` of the key in its next partition, from an aggregate that holds one row per key and
partition. One path for every size, and every comparison is Spark's own, typed one.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions

OPEN_END = _dt.date(9999, 12, 31)


def validity_intervals(df: DataFrame, keys: list[str], from_col: str, tie_cols: list[str],
                       to_col: str = "valid_to", open_end=OPEN_END, num_partitions: int | None = None) -> DataFrame:
    """``valid_to = nvl(lead(valid_from) over (partition by keys order by valid_from, ties), open_end)``.

    NULL keys form a group of their own, as in a window; a NULL ``valid_from`` sorts first."""
    spark = df.sparkSession
    order = [from_col, *tie_cols]
    ranged = (df.repartitionByRange(num_partitions or shuffle_partitions(spark), *keys, *order)
              .withColumn("__part", F.spark_partition_id()))
    # written to the shared folder: the partition numbers are data from here on
    path = scratch_path(spark, "intervals")
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)

    inside = Window.partitionBy("__part", *keys).orderBy(*order)
    led = (placed.withColumn("__next", F.lead(from_col).over(inside))
           .withColumn("__last", F.lead(F.lit(1)).over(inside).isNull()))
    first = F.min(F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")) for c in order])).alias("__first")
    firsts = placed.groupBy("__part", *keys).agg(first)
    along = Window.partitionBy(*keys).orderBy("__part")
    following = firsts.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                              F.lead(F.col("__first")["col1"]["value"]).over(along).alias("__following"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)],
                  F.col("__part") == F.col("__p"))
    joined = led.join(following, same & F.col("__last"), "left")
    end = F.coalesce(F.when(F.col("__last"), F.col("__following")).otherwise(F.col("__next")),
                     F.lit(open_end).cast(df.schema[from_col].dataType))
    return joined.select(*df.columns, end.alias(to_col))


def current_versions(df: DataFrame, keys: list[str], from_col: str, tie_cols: list[str], to_col: str = "valid_to", open_end=OPEN_END) -> DataFrame:
    """The rows that :func:`validity_intervals` leaves open and :func:`current_rows` keeps, without building the other
    intervals: per key the last row that starts before ``open_end``. A partially aggregated ``max_by``, so a hot key costs one row a
    task; NULL keys form one group, a NULL start is never current."""
    end = F.lit(open_end).cast(df.schema[from_col].dataType)
    rest = [c for c in df.columns if c not in keys]
    # NULLs sort first, in the window as in a struct
    last = df.where(F.col(from_col) < end).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(from_col, *tie_cols)).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in df.columns], end.alias(to_col))


def current_rows(intervals: DataFrame, to_col: str = "valid_to", open_end=OPEN_END,
                 from_col: str | None = None) -> DataFrame:
    """Rows whose interval is open (``valid_to = '9999-12-31'``). With ``from_col`` given, zero-length
    intervals (equal-date ties closed by a later change) are excluded as well."""
    cond = F.col(to_col) == F.lit(open_end).cast(intervals.schema[to_col].dataType)
    if from_col:
        cond = cond & (F.col(from_col) < F.col(to_col))
    return intervals.filter(cond)

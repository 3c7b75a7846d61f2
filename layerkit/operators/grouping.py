"""Bounded groups: split a grouping key into chunks of bounded size.

When rows of one key must be gathered (a nested document, a text block), a key that holds a large share of all
rows would land in one task and one row. The rows of each key are counted; a key of at most ``max_rows`` rows is one chunk,
and its rows are not moved. The rows of larger keys are numbered and the numbers cut
into chunks of at most ``max_rows`` rows, in two levels: rows are spread over ``SLICES`` slices of the key by a hash of
their place in the input (not of their columns, so equal rows spread too), numbered inside the slice, and moved on
by the sizes of the slices before theirs (one row per key and slice). A chunk is full but for the last one of
its key, whatever the rows look like; no task sees more than a slice of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SLICES = 64


def bounded_chunks(df: DataFrame, keys: list[str], max_rows: int = 256, chunk_col: str = "chunk", slices: int = SLICES, area: str | None = None) -> DataFrame:
    """``df`` with ``chunk_col``: 0, 1, ... within each key. NULL keys form one group. ``area``: a fresh folder for the tables
    that the result reads (the caller drops it when the result is written)."""
    spark = df.sparkSession
    path = f"{area}/chunks" if area else scratch_path(spark, "chunks")
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slices))
    # written: the slice of a row is data from here on, also when a task is repeated
    df.withColumn("__slice", place).write.parquet(path)
    rows = spark.read.schema(df.withColumn("__slice", place).schema).parquet(path)
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    large_path = f"{area}/large_keys" if area else scratch_path(spark, "large_keys")
    large.write.parquet(large_path)
    large = spark.read.schema(large.schema).parquet(large_path)
    # 0, but no literal: a constant would be folded out of groupings by key and chunk, and rows dealt by both be dealt again
    first = F.floor(F.col("__slice") / F.lit(slices)).cast("long").alias(chunk_col)
    if large.isEmpty():
        return rows.select(*df.columns, first)
    is_large = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    small = rows.join(large, is_large, "left_anti").select(*df.columns, first)
    return small.unionByName(_numbered(rows.join(large, is_large, "left_semi"), df.columns, keys, max_rows, chunk_col))


def chunks_in_place(df: DataFrame, keys: list[str], max_rows: int = 256, chunk_col: str = "chunk") -> DataFrame:
    """The same chunks for rows of which no key is too large for a task: numbered where the key's rows lie, so nothing is written,
    and rows that a join has dealt by the key do not move."""
    inside = Window.partitionBy(*keys).orderBy(F.lit(0))
    return df.withColumn(chunk_col, F.floor((F.row_number().over(inside) - 1) / F.lit(max_rows)).cast("long"))


def _numbered(rows: DataFrame, columns: list[str], keys: list[str], max_rows: int, chunk_col: str) -> DataFrame:
    """The two levels, over rows with their ``__slice``."""
    sizes = rows.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__slice").alias("__s"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(F.lit(0))
    numbered = rows.withColumn("__row", F.row_number().over(inside) - 1)
    same = F.col("__slice") == F.col("__s")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    chunk = F.floor((F.col("__before") + F.col("__row")) / F.lit(max_rows)).cast("long")
    return numbered.join(offsets, same).select(*columns, chunk.alias(chunk_col))

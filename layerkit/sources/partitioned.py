"""Keyed table partitioned by a value derived from its rows.

A :class:`ManifestTable` that clusters its rows by the partition column, an ordinary (last) column of the data
files: NULL, '' and any other value are partitions of their own and keep their types. A merge rewrites the
files that hold matched keys and nothing else. Where the key fixes the partition, files of other partitions
are not looked at; where it does not, the old row is found by its key and moves with its new
partition. A replayed batch (``batch_key``) is skipped; a failed write leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from .manifest import FILE_ROWS, ManifestTable


class PartitionedTable(ManifestTable):
    def __init__(self, spark: SparkSession, path: str, partition_col: str, partition_of: Column, *, file_rows: int = FILE_ROWS):
        super().__init__(spark, path, [partition_col], file_rows=file_rows)
        self.partition_col = partition_col
        self.partition_of = partition_of      # expression over the row giving the partition value

    def _derive(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_col, self.partition_of)

    def _fixed_by(self, keys: list[str], df: DataFrame) -> bool:
        """Whether the key columns alone give the partition (by the columns that the analysed expression refers to)."""
        refers = df.select(self.partition_of)._jdf.queryExecution().analyzed().references().mkString("\n")
        return {name.rsplit("#", 1)[0] for name in refers.split("\n") if name} <= set(keys)

    def merge(self, source: DataFrame, keys: list[str], update_cols: list[str], **kw) -> dict:
        """Upsert ``source`` (columns of the table without the partition column)."""
        return super().merge(self._derive(source), keys, update_cols, prune=self._fixed_by(keys, source), finish=self._derive, **kw)

    def update_where(self, cond: Column, assignments: dict[str, Column], **kw) -> int:
        """``update T set c = expr where cond``; rows move with the partition value."""
        return super().update_where(cond, assignments, finish=self._derive, **kw)

    def publish(self, df: DataFrame, **kw) -> int:
        """Create / replace the whole table (``create table as select``)."""
        rows = df.drop(self.partition_col) if self.partition_col in df.columns else df
        return super().publish(self._derive(rows), **kw)

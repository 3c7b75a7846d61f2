"""Versioned snapshot tables on plain Parquet.

Parquet tables have no row-level MERGE/UPDATE and a static overwrite of a path that the
same plan reads destroys its input. A table is therefore a set of immutable folders, one per
version and never shared by two writers, and a commit log with one entry per version (kind, folder, the
micro-batch that produced it). Readers take the newest logged version. A replayed batch whose id is logged
is skipped. Of two writers one commits a version first: an append then goes on top of it, a full
version, computed from what is no longer the newest one, fails with ``ConcurrentWriteError``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import child_names, drop_folder, move, path_exists
from .commits import CommitLog, ConcurrentWriteError


class SnapshotTable:
    """Versioned table. The log is read once into the object and kept in step with its own writes;
    ``refresh()`` takes in what other writers published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_log")

    # -- log -----------------------------------------------------------------
    def refresh(self) -> "SnapshotTable":
        self.log.refresh()
        return self

    def current_version(self) -> int:
        return self.log.version()

    def has_batch(self, batch_id: int) -> bool:
        return any(e["batch"] == batch_id for e in self.log.entries)

    def version_path(self, v: int) -> str:
        return f"{self.root}/{self.log.entries[v - 1]['path']}"

    # -- read / write --------------------------------------------------------
    def exists(self) -> bool:
        return self.current_version() > 0

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version: its last full image plus the append deltas logged after it."""
        entries = self.log.entries
        if not entries:
            raise FileNotFoundError(f"no published version in {self.root}")
        v = version or len(entries)
        full = max((k for k in range(1, v + 1) if entries[k - 1]["kind"] == "full"), default=1)
        return self.spark.read.parquet(*[self.version_path(k) for k in range(full, v + 1)])

    def _write(self, parts: list[DataFrame], kind: str, batch_id, partition_by) -> int:
        if batch_id is not None and self.has_batch(batch_id):
            return self.current_version()
        path = f"data/{uuid.uuid4().hex}"
        for df in parts:
            w = df.write.mode("append")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(f"{self.root}/{path}")
        while not self.log.commit({"batch": batch_id, "kind": kind, "path": path}):
            self.refresh()
            replayed = batch_id is not None and self.has_batch(batch_id)
            if replayed or kind == "full":
                drop_folder(self.spark, f"{self.root}/{path}")
            if replayed:
                break
            if kind == "full":
                raise ConcurrentWriteError(f"{self.root}: version {self.current_version()} was published meanwhile")
        return self.current_version()

    def publish(self, *parts: DataFrame, batch_id: int | None = None, partition_by: list[str] | None = None) -> int:
        """Full refresh (``truncate; insert`` / ``create or replace``): the rows of ``parts``, written one after the other, become
        the next version."""
        return self._write(list(parts), "full", batch_id, partition_by)

    def append(self, df: DataFrame, *, batch_id: int | None = None) -> int:
        """``insert into T select ...``: only the new rows are written, as a delta version."""
        return self._write([df], "append", batch_id, None)

    def compact(self, num_files: int | None = None) -> int:
        """Fold the append deltas since the last full version into a new full version (fewer,
        larger files for readers). Readers of older versions are not affected."""
        df = self.read()
        if num_files:
            df = df.repartition(num_files)
        return self._write([df], "full", None, None)


class AppendTable:
    """Append-only table fed by micro-batches: each batch has its own folder ``batch-<n>``. The folder
    is written aside and renamed into the table, so it appears whole and once: a replayed batch finds
    it and keeps its files, which consumers of the table may already have read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def exists(self) -> bool:
        """Whether a batch is in the table (one that failed on its way is not)."""
        return any(n.startswith("batch-") for n in child_names(self.spark, self.root))

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batch-{batch_id:010d}"

    def append(self, df: DataFrame, *, batch_id: int) -> bool:
        """Whether rows were written (not: the batch is in the table already)."""
        folder = self._folder(batch_id)
        if path_exists(self.spark, folder):
            return False
        aside = f"{self.root}/_staged/{batch_id:010d}"
        df.write.mode("overwrite").parquet(aside)
        move(self.spark, aside, folder)
        return True

    def read(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.root)

    def batch(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._folder(batch_id))

    def stream(self, schema: T.StructType) -> DataFrame:
        """Change stream: rows of batches written since the consumer's checkpoint."""
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).option("recursiveFileLookup", "true").parquet(self.root)

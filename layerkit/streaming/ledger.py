"""File loads that keep their own ledger.

Every load appends rows and, in the same version of the target, one ledger row per file it looked at: file, size,
modification time, rows parsed and loaded, errors, first error, status, load time. A file is known by its name, size
and time, so the same name with new content is loaded again. The ledger is read without touching the target's rows.

Status (fixed values): LOADED, PARTIALLY_LOADED (some rows could not be read and were left out), LOAD_FAILED.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.manifest import ManifestTable
from ..sources.stage import FileFormat, relative_file, stage_listing

_BAD = "__bad_record"
LEDGER_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("file_size", T.LongType()), T.StructField("last_modified", T.TimestampType()),
    T.StructField("row_parsed", T.LongType()), T.StructField("row_count", T.LongType()), T.StructField("error_count", T.LongType()),
    T.StructField("first_error", T.StringType()), T.StructField("status", T.StringType()), T.StructField("last_load_time", T.TimestampType()),
    T.StructField("table_name", T.StringType())])


class LoadFailedError(RuntimeError):
    """A load with ``on_error='abort'`` met rows it could not read; nothing was loaded, the ledger says which files."""


class LedgerLoad:
    """``copy into <table> from @stage`` with its copy history.

    ``on_error``: 'abort' (a bad row fails the whole load), 'skip_file' (files with a bad row are not loaded), 'continue'
    (bad rows are left out)."""

    def __init__(self, spark: SparkSession, stage_path: str, table: ManifestTable, name: str, schema: T.StructType, fmt: FileFormat, *, on_error: str = "abort"):
        if on_error not in ("abort", "skip_file", "continue"):
            raise ValueError("on_error must be 'abort', 'skip_file' or 'continue'")
        self.spark, self.stage_path, self.table, self.name = spark, stage_path.rstrip("/"), table, name
        self.schema, self.fmt, self.on_error = schema, fmt, on_error

    # -- ledger -------------------------------------------------------------------
    def history(self, since=None) -> DataFrame:
        """Copy history of the table, newest first; ``since``: a time, only loads from then on."""
        folders = [f"{self.table.root}/{e['ledger']}" for e in self.table.refresh().log.entries if e.get("ledger")]
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = rows.where(F.col("table_name") == self.name)
        if since is not None:
            rows = rows.where(F.col("last_load_time") >= since)
        return rows.orderBy(F.desc("last_load_time"), "file_name")

    def _staged(self) -> DataFrame:
        listing = stage_listing(self.spark, self.stage_path).where(~F.col("name").rlike("/[_.][^/]*$"))
        root = self.stage_path.split("://")[-1].removeprefix("file:")
        at = F.instr(F.col("name"), F.lit(root + "/"))
        return listing.select(F.expr("substring(name, 1)").alias("path"), F.substring(F.col("name"), at + F.lit(len(root) + 1), F.length("name")).alias("file_name"),
                              F.col("size").alias("file_size"), "last_modified")

    def pending(self, force: bool = False) -> DataFrame:
        """Staged files that no load has taken in yet (all of them with ``force``)."""
        staged = self._staged()
        if force:
            return staged
        known = self.history().where("status <> 'LOAD_FAILED'").select("file_name", "file_size", "last_modified").distinct()
        return staged.join(known, ["file_name", "file_size", "last_modified"], "left_anti")

    # -- load -----------------------------------------------------------------------
    def run(self, force: bool = False) -> dict:
        """Load what is pending; files by status and rows loaded."""
        files = self.pending(force).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            paths = [r["path"] for r in files.select("path").collect()]        # one per file
            return self._load(files, paths) if paths else {"rows": 0}
        finally:
            files.unpersist()

    def _read(self, paths: list[str]) -> DataFrame:
        options = self.fmt.options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        schema = T.StructType([*self.schema.fields, T.StructField(_BAD, T.StringType())])
        reader = self.spark.read.options(**options).schema(schema)
        df = reader.csv(paths) if self.fmt.kind == "csv" else reader.json(paths)
        return df.withColumn("source_file_name", relative_file(self.stage_path))

    def _load(self, files: DataFrame, paths: list[str]) -> dict:
        rows = self._read(paths).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = rows.groupBy(F.col("source_file_name").alias("file_name")).agg(
                F.count(F.lit(1)).alias("row_parsed"), F.count(_BAD).alias("error_count"), F.min(_BAD).alias("first_error"))
            counted = files.join(seen, "file_name", "left").fillna(0, ["row_parsed", "error_count"])
            bad = F.col("error_count") > 0
            failed = bad if self.on_error != "continue" else F.lit(False)
            abort = self.on_error == "abort" and not counted.where(bad).isEmpty()
            status = F.when(failed, "LOAD_FAILED").when(bad, "PARTIALLY_LOADED").otherwise("LOADED")
            ledger = counted.withColumn("status", status)
            if abort:                              # files without an error were not loaded either
                ledger = ledger.where(bad)
            now = _dt.datetime.now(_dt.timezone.utc)
            ledger = ledger.select("file_name", "file_size", "last_modified", "row_parsed",
                                   F.when(F.col("status") == "LOAD_FAILED", 0).otherwise(F.col("row_parsed") - F.col("error_count")).cast("long").alias("row_count"),
                                   "error_count", "first_error", "status", F.lit(now).cast("timestamp").alias("last_load_time"), F.lit(self.name).alias("table_name"))
            folder = f"ledger/{uuid.uuid4().hex}"
            ledger.coalesce(1).write.parquet(f"{self.table.root}/{folder}")
            good = rows.where(F.col(_BAD).isNull())
            if self.on_error == "skip_file":
                good = good.join(seen.where(bad).select(F.col("file_name").alias("source_file_name")), "source_file_name", "left_anti")
            columns = [*self.schema.names, "source_file_name"]
            if abort:
                self.table.note(self._empty(columns, rows), ledger=folder)
            else:
                self.table.append(good.select(*columns, F.lit(now).cast("timestamp").alias("load_ts")), extra={"ledger": folder})
            done = {r["status"]: r["n"] for r in self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.table.root}/{folder}")
                    .groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
            if abort:
                raise LoadFailedError(f"{self.name}: {done.get('LOAD_FAILED', 0)} files with rows that could not be read")
            loaded = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.table.root}/{folder}").agg(F.sum("row_count")).first()[0]
            return done | {"rows": int(loaded or 0)}
        finally:
            rows.unpersist()

    @staticmethod
    def _empty(columns: list[str], rows: DataFrame) -> DataFrame:
        return rows.limit(0).select(*columns, F.current_timestamp().alias("load_ts"))

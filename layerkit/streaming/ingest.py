"""Continuous / batch file ingest: every staged file is loaded exactly once.

A file-source stream remembers the files it has read in its checkpoint, so running the
same load again appends only files that arrived since (``copy into`` load memory, pipes,
``alter pipe refresh``). ``trigger(availableNow=True)`` processes everything present and
stops - the batch form; ``processing_time`` keeps it running - the continuous form.
"""

from __future__ import annotations

import datetime as _dt
import re
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..session import path_exists, scratch_path
from ..sources.stage import FileFormat, _load_ts, _strip_scheme, relative_file, stage_listing


def stream_stage(spark: SparkSession, stage_path: str, schema: T.StructType | None,
                 fmt: FileFormat, *, variant_col: str | None = None, load_ts=None,
                 max_files_per_trigger: int | None = None, clean_source: str | None = None,
                 with_file: bool = True) -> DataFrame:
    r = spark.readStream.options(**fmt.options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:   # purge = true -> "delete"; or "archive" with sourceArchiveDir
        r = r.option("cleanSource", clean_source)
    if fmt.kind == "json" and variant_col:
        df = r.option("singleVariantColumn", variant_col).json(stage_path)
    else:
        r = r.schema(schema)
        df = r.csv(stage_path) if fmt.kind == "csv" else r.json(stage_path)
    cols = [F.col(c) for c in df.columns]
    if with_file:
        cols += [relative_file(stage_path).alias("source_file_name"), _load_ts(load_ts).alias("load_ts")]
    return df.select(*cols)


class _Batches(StreamingQueryListener):
    """Every progress event of the queries of a run (a query itself keeps only its last ones):
    (batch id, time, input rows, milliseconds), one small tuple per batch."""

    def __init__(self):
        self.of: dict[str, list[tuple]] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.of.setdefault(str(p.runId), []).append((p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution", 0)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.end_of(str(event.runId)).set()


def _run(spark: SparkSession, writer, start_path: str | None = None) -> list[tuple]:
    """Process everything present and stop; the batches that ran."""
    seen = _Batches()
    spark.streams.addListener(seen)
    try:
        writer = writer.trigger(availableNow=True)
        q = writer.start(start_path) if start_path else writer.start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        run_id = str(q.runId)
        if not seen.end_of(run_id).wait(60):       # events arrive in order, the end last
            raise TimeoutError("the end of the streaming query was not reported")
        return seen.of.get(run_id, [])
    finally:
        spark.streams.removeListener(seen)


def _start(writer, processing_time: str, start_path: str | None = None):
    """Keep running; returns the running query."""
    writer = writer.trigger(processingTime=processing_time)
    return writer.start(start_path) if start_path else writer.start()


def purge(spark: SparkSession, files: list[tuple[str, int, _dt.datetime]] | DataFrame) -> int:
    """Delete staged files noted as (path, size, last_modified); one that was delivered again since, with another size or
    time, is not the file that was noted and stays. Returns the number of files deleted.

    The driver walks the noted files (metadata: one entry a file), through the stage's own file system."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    noted = files.select("path", "size", F.unix_millis("last_modified").alias("millis")).toLocalIterator() if isinstance(files, DataFrame) else files
    for path, size, when in noted:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            status = fs.getFileStatus(p)
            if (status.getLen(), status.getModificationTime()) == (size, when) and fs.delete(p, False):
                n += 1
    return n


def rows_in(batches: list[tuple]) -> int:
    return sum(b[2] for b in batches)


@dataclass
class FileIngest:
    """``copy into <target> from (select $1.., metadata$filename, current_timestamp() from @stage)``."""
    spark: SparkSession
    stage_path: str
    target_path: str
    checkpoint_path: str
    fmt: FileFormat
    schema: T.StructType | None = None
    variant_col: str | None = None
    load_ts: object = None
    purge: bool = False
    # bounds one micro-batch: a backlog of many files is loaded as a sequence of batches
    max_files_per_trigger: int | None = 1000

    def source(self) -> DataFrame:
        return stream_stage(self.spark, self.stage_path, self.schema, self.fmt,
                            variant_col=self.variant_col, load_ts=self.load_ts,
                            max_files_per_trigger=self.max_files_per_trigger)

    def _staged(self) -> DataFrame:
        """What lies in the stage: path, size and time of each file."""
        root = self.stage_path.rstrip("/") + "/"
        listing = stage_listing(self.spark, self.stage_path)
        at = F.instr("name", F.lit(_strip_scheme(root))) + F.lit(len(_strip_scheme(root)))
        return listing.select(F.col("name").alias("path"), F.substring(F.col("name"), at, F.length("name")).alias("source_file_name"), "size", "last_modified")

    def _purge_batches(self, noted: DataFrame, since) -> int:
        """Delete the files noted before the load whose rows the load has committed, and those without rows (``purge = true``)."""
        loaded = self.read()
        if since is not None:                  # the files of earlier runs are skipped by their statistics
            loaded = loaded.filter(F.col("load_ts") >= F.lit(since))
        names = loaded.select("source_file_name").distinct()
        deleted = purge(self.spark, noted.join(names, "source_file_name", "left_semi"))
        return deleted + purge(self.spark, self._without_rows(noted.join(names, "source_file_name", "left_anti")))

    def _without_rows(self, files: DataFrame) -> DataFrame:
        """Those of the files that hold a header at most: no loaded row can name them. Files that were not loaded for another
        reason (delivered again under a loaded name) have lines and stay."""
        paths = [r["path"] for r in files.select("path").collect() if path_exists(self.spark, r["path"])]     # one per file
        if not paths:
            return files.limit(0)
        lines = self.spark.read.text([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]).where(F.length(F.trim("value")) > 0)
        header = 1 if self.fmt.kind == "csv" and self.fmt.options.get("header") == "true" else 0
        full = lines.groupBy(relative_file(self.stage_path).alias("source_file_name")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > header)
        return files.join(full, "source_file_name", "left_anti")

    def run(self) -> int:
        """Load files not loaded before into the target (Parquet file sink, exactly once). Returns rows."""
        w = (self.source().writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", self.checkpoint_path))
        started = _dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(seconds=1)
        noted = None
        if self.purge and path_exists(self.spark, self.stage_path):
            path = scratch_path(self.spark, "purge_notes")       # the list as of now, whatever is delivered meanwhile
            self._staged().write.parquet(path)
            noted = self.spark.read.parquet(path)
        batches = _run(self.spark, w, self.target_path)
        if noted is not None:
            self._purge_batches(noted, started if self.load_ts is None else None)
        return rows_in(batches)

    def start_continuous(self, processing_time: str = "1 minute"):
        """The pipe form: keep loading new files every ``processing_time``; returns the running query."""
        w = (self.source().writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", self.checkpoint_path))
        return _start(w, processing_time, self.target_path)

    def run_each(self, on_batch) -> int:
        """Same, but each micro-batch goes to ``on_batch(df, batch_id)`` (e.g. append + merge)."""
        w = self.source().writeStream.foreachBatch(on_batch).option("checkpointLocation", self.checkpoint_path)
        return rows_in(_run(self.spark, w))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.target_path)

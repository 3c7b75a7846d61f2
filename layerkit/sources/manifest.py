"""Keyed table whose versions are lists of immutable files.

A version is a manifest: one row per data file with its row count and the smallest and largest cluster
values in it. A change writes new files, a new manifest that keeps untouched files by reference, the change
rows (before and after images) beside it, and publishes all of it in one step by a version of the
commit log. A failure before that step leaves the table as it was; a batch's name is part of
the version, so a replayed batch is known. Of two writers the second repeats its change on the newer version.

* Rows are written range-partitioned and sorted by the cluster columns, so a file holds a contiguous range;
  there are no partition folders, so NULL and '' are values like others and keep their types.
* A merge narrows the files by the key runs of its source (smallest and largest cluster values of ``RUNS`` range
  partitions, against the manifest), finds the files that really hold one of its keys by a semi-join that
  reads the key columns only, and rewrites those. New keys go to new files.
* ``index`` names columns with a value-to-file index: per new folder of files the hashes of their values, sorted; a
  look-up finds its files there and reads no other.
* ``recluster`` rewrites the files that overlap most and leaves the others.
* ``changes(after, upto)`` reads the change rows of these versions only, and folds several changes of a
  key into one net change.

Rows whose key has a NULL part match nothing (as in SQL); each merge inserts them again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import ACTION as IMAGE
from ..operators.changes import IS_UPDATE, fold_changes, snapshot_diff
from ..operators.layout import sweep
from ..operators.upsert import ACTION, merge_frame
from ..session import drop_folder
from .commits import CommitLog, ConcurrentWriteError

RUNS = 32               # ranges of a source that are compared with the manifest
RETRIES = 5
FILE_ROWS = 2_000_000   # rows of a data file at most
_PRE = "__pre"


def data_file() -> Column:
    """Folder and name of the data file a row comes from (cut, not matched by a pattern: it is taken for every row)."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -2)


class ManifestTable:
    def __init__(self, spark: SparkSession, root: str, cluster: list[str], *, file_rows: int = FILE_ROWS, index: list[str] = ()):
        self.spark, self.root = spark, root.rstrip("/")
        self.cluster, self.file_rows, self.index = cluster, file_rows, list(index)
        self.log = CommitLog(spark, f"{self.root}/_log")

    # -- versions -------------------------------------------------------------
    def refresh(self) -> "ManifestTable":
        self.log.refresh()
        return self

    def current_version(self) -> int:
        return self.log.version()

    def exists(self) -> bool:
        return self.refresh().current_version() > 0

    def _entry(self, version: int | None = None) -> dict:
        entries = self.log.entries
        if not entries:
            raise FileNotFoundError(f"no published version in {self.root}")
        return entries[(version or len(entries)) - 1]

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._entry(version)["schema"]))

    def has_batch(self, batch_key: str | None) -> bool:
        return batch_key is not None and any(e["batch"] == batch_key for e in self.log.entries)

    def batch(self, batch_key: str) -> DataFrame:
        """The rows that an appended (or first) batch brought, whatever became of them since."""
        for version, e in enumerate(self.log.entries, 1):
            if e["batch"] == batch_key and e["kind"] in ("full", "append"):
                return self.spark.read.schema(self.schema(version)).parquet(f"{self.root}/{e.get('added') or e['data']}")
        raise KeyError(f"{self.root}: no appended batch {batch_key}")

    # -- reading --------------------------------------------------------------
    def manifest(self, version: int | None = None) -> DataFrame:
        """file (below ``data``), rows, bytes, lo, hi: one row per data file of a version."""
        return self.spark.read.parquet(f"{self.root}/{self._entry(version)['manifest']}")

    def files(self, version: int | None = None) -> list[str]:
        return sorted(r["file"] for r in self.manifest(version).select("file").collect())

    def read_files(self, files: list[str], version: int | None = None) -> DataFrame:
        return self._read_files(files, self.schema(version))

    def _read_files(self, files: list[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}" for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest one known here). Files that make up a whole folder are read as
        the folder, so the list of paths stays short."""
        listed = self.manifest(version).groupBy(F.substring_index("file", "/", 1).alias("folder")).agg(
            F.count(F.lit(1)).alias("n"), F.first("folder_files").alias("all"), F.when(F.count(F.lit(1)) < F.first("folder_files"), F.collect_list("file")).alias("files"))
        paths = [p for r in listed.collect() for p in (r["files"] or [r["folder"]])]
        return self._read_files(sorted(paths), self.schema(version))

    def lookup(self, column: str, value) -> DataFrame:
        """Rows with ``column = value``; only files that the index names are read. (The hash of NULL is the hash's seed; NULL equals
        nothing, as in SQL.)"""
        if column not in self.index:
            raise ValueError(f"no index on {column}")
        typed = F.lit(value).cast(self.schema()[column].dataType)
        live = self.manifest().select("file")
        folders = [r[0] for r in live.select(F.substring_index("file", "/", 1)).distinct().collect()]
        entries = self.spark.read.parquet(*[f"{self.root}/{self._index_folder(f, column)}" for f in folders]) if folders else None
        files = [] if entries is None else sorted(r["file"] for r in entries.where(F.col("hash") == F.xxhash64(typed)).select("file").distinct()
                                                  .join(live, "file", "left_semi").collect())
        return self.read_files(files).where(F.col(column) == typed)

    # -- writing --------------------------------------------------------------
    def _transact(self, batch_key: str | None, build: Callable[[], tuple[dict, object]], nothing):
        """Publish what ``build`` made on the newest version; again if another writer was first."""
        for _ in range(RETRIES):
            self.refresh()
            if self.has_batch(batch_key):
                return nothing
            entry, result = build()
            if entry is None:
                return result
            if self.log.commit(entry | {"batch": batch_key}):
                return result
            for kind in ("data", "changes", "manifest"):       # not published: nobody reads it
                if entry.get(kind) and entry["kind"] != "note":
                    drop_folder(self.spark, f"{self.root}/{entry[kind]}")
        raise ConcurrentWriteError(f"{self.root}: other writers were first {RETRIES} times")

    def _write_data(self, rows: DataFrame, order: list[str] = (), after: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
        """``after`` is applied behind the exchange, so that what it observes is not counted by the sampling of the ranges. Rows
        with equal values are ranged by a hash of the row, so a value that many rows share is written by several tasks."""
        folder = f"data/{uuid.uuid4().hex}"
        by = list(dict.fromkeys([*self.cluster, *order]))
        spread = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
        ordered = after(rows.repartitionByRange(*by, F.xxhash64(*spread)).sortWithinPartitions(*by))
        ordered.write.option("maxRecordsPerFile", self.file_rows).parquet(f"{self.root}/{folder}")
        for column in self.index:
            values = self.spark.read.schema(ordered.schema).parquet(f"{self.root}/{folder}").select(F.xxhash64(column).alias("hash"), data_file().alias("file"))
            values.distinct().repartitionByRange("hash").sortWithinPartitions("hash").write.parquet(f"{self.root}/{self._index_folder(folder, column)}")
        return folder

    @staticmethod
    def _index_folder(data: str, column: str) -> str:
        return f"index/{data.rsplit('/', 1)[-1]}/{column}"

    def _statistics(self, folder: str, schema: T.StructType) -> DataFrame:
        """Manifest rows of new files (reads their cluster columns once)."""
        key = F.struct(*self.cluster)
        per_file = (self.spark.read.schema(schema).parquet(f"{self.root}/{folder}").select(data_file().alias("file"), F.col("_metadata.file_size").alias("bytes"), key.alias("k"))
                    .groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"), F.min("k").alias("lo"), F.max("k").alias("hi")))
        # one row per new file of this folder
        in_folder = Window.partitionBy(F.substring_index("file", "/", 1))
        return per_file.select("file", "rows", "bytes", "lo", "hi", F.count(F.lit(1)).over(in_folder).alias("folder_files"))

    def _write_manifest(self, dropped: list[str], folder: str | None, schema: T.StructType) -> str:
        parts = [self._statistics(folder, schema)] if folder else []
        if self.log.entries:
            old = self.manifest()
            if dropped:
                gone = self.spark.createDataFrame([(f,) for f in dropped], "file string")
                old = old.join(gone, "file", "left_anti")
            parts.append(old)
        path = f"manifests/{uuid.uuid4().hex}"
        reduce(DataFrame.unionByName, parts).coalesce(4).write.parquet(f"{self.root}/{path}")
        return path

    def _write_changes(self, images: DataFrame) -> str:
        path = f"changes/{uuid.uuid4().hex}"
        images.write.parquet(f"{self.root}/{path}")
        return path

    @staticmethod
    def _nullable(schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def publish(self, df: DataFrame, *, batch_key: str | None = None, extra: dict | None = None) -> int:
        """Create the table, or replace all of it; the version. ``extra``: more entries of the version."""
        schema = self._nullable(df.schema)

        def build():
            data = self._write_data(df)
            path = f"manifests/{uuid.uuid4().hex}"
            self._statistics(data, schema).coalesce(4).write.parquet(f"{self.root}/{path}")
            return {"kind": "full", "schema": schema.json(), "data": data, "manifest": path, "changes": None} | (extra or {}), self.current_version() + 1
        return self._transact(batch_key, build, self.current_version())

    def note(self, empty: DataFrame, **extra) -> int:
        """A version without a change of rows that carries ``extra`` (of a new table: without rows)."""
        if not self.exists():
            return self.publish(empty, extra=extra)

        def build():
            last = self._entry()
            return {"kind": "note", "schema": last["schema"], "manifest": last["manifest"], "changes": None} | extra, self.current_version() + 1
        return self._transact(None, build, self.current_version())

    def append(self, df: DataFrame, *, batch_key: str | None = None, extra: dict | None = None) -> int:
        """Insert rows into new files. Returns the number of rows (0 for a batch that is in the table)."""
        if not self.exists():
            before, version = self.current_version(), self.publish(df, batch_key=batch_key, extra=extra)
            return int(self.manifest(version).agg(F.sum("rows")).first()[0] or 0) if version > before else 0
        if self.has_batch(batch_key):
            return 0
        schema = self.schema()
        data = self._write_data(df.select(*schema.names))      # the files fit any version

        def build():
            manifest = self._write_manifest([], data, schema)
            return {"kind": "append", "schema": schema.json(), "manifest": manifest, "changes": None, "added": data} | (extra or {}), data
        if self._transact(batch_key, build, None) is None:
            return 0
        return int(self.manifest().where(F.col("file").startswith(data.split("/")[1] + "/")).agg(F.sum("rows")).first()[0] or 0)

    # -- finding files -----------------------------------------------------------
    def _overlapping(self, source: DataFrame) -> list[str]:
        """Files whose range of cluster values meets a run of the source."""
        runs = (source.select(*self.cluster).repartitionByRange(RUNS, *self.cluster).select(F.spark_partition_id().alias("run"), F.struct(*self.cluster).alias("k"))
                .groupBy("run").agg(F.min("k").alias("run_lo"), F.max("k").alias("run_hi")))
        # at most RUNS rows against one row per file
        hits = self.manifest().join(F.broadcast(runs), (F.col("hi") >= F.col("run_lo")) & (F.col("lo") <= F.col("run_hi")), "left_semi")
        return [r["file"] for r in hits.select("file").collect()]

    def touched_files(self, source: DataFrame, keys: list[str], prune: bool | None = None) -> list[str]:
        """Files that hold a key of the source: candidates by range, then by the key columns. ``prune``: the key fixes the
        cluster values (by default: when they are columns of the key)."""
        known = source.select(*keys).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        candidates = self._overlapping(source) if (set(self.cluster) <= set(keys) if prune is None else prune) else self.files()
        if not candidates:
            return []
        here = self._read_files(candidates, self.schema()).select(*keys, data_file().alias("__file"))
        return sorted(r[0] for r in here.join(known.distinct(), keys, "left_semi").select("__file").distinct().collect())

    def _files_where(self, cond: Column) -> list[str]:
        return sorted(r[0] for r in self.read().where(cond).select(data_file()).distinct().collect())

    # -- changes of rows -----------------------------------------------------------
    def _rewrite(self, files: list[str], judged: DataFrame, keep: Column | None, names: list[str], observed: dict[str, Column], order: list[str] = ()) -> tuple[dict, dict]:
        """Replace ``files`` by the rows of ``judged``: its columns, ``__pre`` (the row before, or null) and
        ``_merge_action`` (keep, update, insert, delete)."""
        schema = self.schema() if self.log.entries else self._nullable(judged.select(*names).schema)
        judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if keep is not None:
                judged = judged.withColumn(ACTION, F.when(~F.coalesce(keep, F.lit(True)) & (F.col(ACTION) != "keep"), F.when(F.col(_PRE).isNull(), "nothing").otherwise("delete")).otherwise(F.col(ACTION)))
            obs = Observation("rewrite")
            data = self._write_data(judged.select(*names, ACTION), order, lambda df: df.observe(obs, *[F.count(F.when(c, 1)).alias(n) for n, c in observed.items()])
                                    .where(~F.col(ACTION).isin("delete", "nothing")).select(*names))
            counts = {k: int(v) for k, v in obs.get.items()}
            update = F.col(ACTION) == "update"
            before = F.when(F.col(ACTION).isin("update", "delete"), F.struct(*[F.col(_PRE)[c].alias(c) for c in names], F.lit("DELETE").alias(IMAGE), update.alias(IS_UPDATE)))
            after = F.when(F.col(ACTION).isin("update", "insert"), F.struct(*names, F.lit("INSERT").alias(IMAGE), update.alias(IS_UPDATE)))
            images = judged.where(F.col(ACTION).isin("update", "insert", "delete")).select(F.inline(F.filter(F.array(before, after), lambda x: x.isNotNull())))
            changes = self._write_changes(images)
            manifest = self._write_manifest(files, data, schema)
        finally:
            judged.unpersist()
        return {"kind": "rewrite", "schema": schema.json(), "data": data, "manifest": manifest, "changes": changes}, counts

    def merge(self, source: DataFrame, keys: list[str], update_cols: list[str], *, batch_key: str | None = None, keep: Column | None = None,
              prune: bool | None = None, finish: Callable[[DataFrame], DataFrame] = lambda df: df, **kw) -> dict:
        """Upsert by key; only files that hold a matched key are rewritten. ``keep`` is judged on the changed rows after
        the merge: those it is false for are deleted. ``finish`` computes derived columns of the merged rows. Reports the
        rows updated and inserted."""
        none = {"updated": 0, "inserted": 0}
        if self.refresh().has_batch(batch_key):
            return none
        source = source.persist(StorageLevel.MEMORY_AND_DISK)

        def build():
            if self.log.entries:
                schema = self.schema()
                files = self.touched_files(source, keys, prune)
                target = self._read_files(files, schema)
            else:
                schema, files, target = source.schema, [], source.limit(0)
            names = schema.names
            target = target.select(*names, F.struct(*names).alias(_PRE))
            merged = finish(merge_frame(target, source, keys, update_cols, **kw))
            return self._rewrite(files, merged, keep, names, {"updated": F.col(ACTION) == "update", "inserted": F.col(ACTION) == "insert"}, keys)
        try:
            return self._transact(batch_key, build, none)
        finally:
            source.unpersist()

    def update_where(self, cond: Column, assignments: dict[str, Column], *, batch_key: str | None = None,
                     finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
        """``update T set c = expr where cond``: only files that hold matching rows are rewritten."""
        hit = F.coalesce(cond, F.lit(False))

        def build():
            files = self._files_where(hit)
            if not files:
                return None, 0
            names = self.schema().names
            here = self._read_files(files, self.schema())
            new = [F.when(hit, assignments[c]).otherwise(F.col(c)).cast(here.schema[c].dataType).alias(c) if c in assignments else F.col(c) for c in names]
            judged = here.select(*new, F.struct(*names).alias(_PRE), F.when(hit, "update").otherwise("keep").alias(ACTION))
            entry, counts = self._rewrite(files, finish(judged), None, names, {"n": F.col(ACTION) == "update"})
            return entry, counts["n"]
        return self._transact(batch_key, build, 0)

    def delete_where(self, cond: Column, *, batch_key: str | None = None) -> int:
        hit = F.coalesce(cond, F.lit(False))

        def build():
            files = self._files_where(hit)
            if not files:
                return None, 0
            names = self.schema().names
            judged = self._read_files(files, self.schema()).select(*names, F.struct(*names).alias(_PRE), F.when(hit, "delete").otherwise("keep").alias(ACTION))
            entry, counts = self._rewrite(files, judged, None, names, {"n": F.col(ACTION) == "delete"})
            return entry, counts["n"]
        return self._transact(batch_key, build, 0)

    def replace_keys(self, gone: DataFrame, rows: DataFrame, keys: list[str], *, batch_key: str | None = None) -> dict:
        """Take out the rows whose key is in ``gone`` and put in ``rows``; files without such a key stay."""
        none = {"deleted": 0, "inserted": 0}
        if self.refresh().has_batch(batch_key):
            return none
        gone = gone.select(*keys).distinct().persist(StorageLevel.MEMORY_AND_DISK)

        def build():
            names = self.schema().names
            files = self.touched_files(gone, keys)
            here = self._read_files(files, self.schema()).select(*names, F.struct(*names).alias(_PRE))
            marked = here.join(gone.withColumn("__gone", F.lit(True)), keys, "left")
            old = marked.select(*names, _PRE, F.when(F.col("__gone"), "delete").otherwise("keep").alias(ACTION))
            new = rows.select(*names, F.lit(None).cast(old.schema[_PRE].dataType).alias(_PRE), F.lit("insert").alias(ACTION))
            return self._rewrite(files, old.unionByName(new), None, names, {"deleted": F.col(ACTION) == "delete", "inserted": F.col(ACTION) == "insert"})
        try:
            return self._transact(batch_key, build, none)
        finally:
            gone.unpersist()

    # -- layout ------------------------------------------------------------------
    def depths(self) -> DataFrame:
        """Per file: range of cluster values, depth where it starts, number of files that overlap it."""
        return sweep(self.manifest().select(F.col("file").alias("file_name"), F.col("lo").alias("min_key"), F.col("hi").alias("max_key")))

    def recluster(self, most_depth: int = 1, *, rounds: int = 10, file_bytes: int | None = None) -> int:
        """While some value lies in more than ``most_depth`` files, rewrite the files that hold the deepest one, by range (files of
        about ``file_bytes``, if given). Other files stay. Returns the number of files rewritten; rows do not change."""
        done = 0
        for _ in range(rounds):
            def build():
                deepest = self.depths().where(F.col("depth") > most_depth).orderBy(F.desc("depth"), "min_key").limit(1).select("min_key")
                # the row holds one value: files whose range holds it
                hit = self.manifest().join(F.broadcast(deepest), (F.col("lo") <= F.col("min_key")) & (F.col("hi") >= F.col("min_key")), "left_semi").select("file", "rows", "bytes").collect()
                if not hit:
                    return None, 0
                schema, files = self.schema(), [r["file"] for r in hit]
                rows_of, kept = sum(r["rows"] for r in hit), self.file_rows
                if file_bytes:
                    self.file_rows = max(1, int(file_bytes * rows_of / max(1, sum(r["bytes"] for r in hit))))
                try:
                    data = self._write_data(self._read_files(files, schema))
                finally:
                    self.file_rows = kept
                return {"kind": "recluster", "schema": schema.json(), "data": data, "manifest": self._write_manifest(files, data, schema), "changes": None}, len(files)
            n = self._transact(None, build, 0)
            if not n:
                break
            done += n
        return done

    # -- change feed -----------------------------------------------------------
    def change_rows(self, version: int, keys: list[str]) -> DataFrame:
        """The images of one version. Inserted files are their own images; a replaced table is compared."""
        entry = self._entry(version)
        if entry["changes"]:
            return self.spark.read.parquet(f"{self.root}/{entry['changes']}")
        if entry["kind"] == "append":
            rows = self.spark.read.schema(self.schema(version)).parquet(f"{self.root}/{entry['added']}")
            return rows.select("*", F.lit("INSERT").alias(IMAGE), F.lit(False).alias(IS_UPDATE))
        now = self.read(version)
        if entry["kind"] in ("note", "recluster"):
            return now.limit(0).select("*", F.lit("INSERT").alias(IMAGE), F.lit(False).alias(IS_UPDATE))
        return snapshot_diff(self.read(version - 1) if version > 1 else now.limit(0), now, keys)

    def changes(self, after: int, upto: int, keys: list[str]) -> DataFrame:
        """Net change rows of the versions (after, upto]."""
        parts = [self.change_rows(v, keys).withColumn("__version", F.lit(v)) for v in range(after + 1, upto + 1)]
        if not parts:
            return self.read().limit(0).select("*", F.lit("INSERT").alias(IMAGE), F.lit(False).alias(IS_UPDATE))
        return fold_changes(reduce(DataFrame.unionByName, parts), keys, "__version")

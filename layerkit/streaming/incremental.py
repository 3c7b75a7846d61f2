"""Incrementally maintained tables (dynamic tables) and change streams on append-only tables.

* change stream: ``readStream`` over the Parquet folder of an append-only table; the
  checkpoint is the stream offset, so each run sees only rows appended since the last one.
* incremental flatten / join: map-only or stream-static join per micro-batch, appended
  to a snapshot table under the batch id (a replayed batch is skipped).
* incremental aggregate: per batch the *delta* sums are computed and merged additively
  (``union`` + ``groupBy.sum``, partially aggregated) into a summary kept at fact-key grain;
  dimension attributes are joined when it is read, so a changed dimension row re-groups
  old facts correctly without a full recomputation.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import ACTION, ChangeFeed
from ..session import newest_marker, path_exists, write_marker
from ..sources.manifest import ManifestTable
from ..sources.snapshot import AppendTable, SnapshotTable
from .ingest import _run, _start, rows_in


def change_stream(spark: SparkSession, table_path: str, schema: T.StructType,
                  max_files_per_trigger: int | None = 1000, partitioned: bool = False) -> DataFrame:
    """Rows appended to a Parquet table since the consumer's checkpoint (a backlog is consumed in
    batches of at most ``max_files_per_trigger`` files). Subfolders are read too; their names are columns only
    of a ``partitioned`` table."""
    r = spark.readStream.schema(schema)
    if not partitioned:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(table_path)


class RefreshAudit:
    """Audit table of refreshes: table, batch, time, input rows, milliseconds; appended by the refresh, kept when its process ends.
    A batch that was audited is not audited again."""

    SCHEMA = "table_name string, batch_id bigint, refreshed_at timestamp, input_rows bigint, duration_ms bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.rows = spark, SnapshotTable(spark, root)

    def record(self, name: str, history: list[tuple]) -> int:
        new = [(name, int(b), _dt.datetime.fromisoformat(str(t).replace("Z", "+00:00")), int(n), int(d)) for b, t, n, d in history if n > 0]
        known = {r["batch_id"] for r in self.read(name).where(F.col("batch_id").isin([r[1] for r in new])).select("batch_id").collect()} if new else set()
        new = [r for r in new if r[1] not in known]
        if new:
            self.rows.append(self.spark.createDataFrame(new, self.SCHEMA).coalesce(1))
        return len(new)

    def read(self, name: str | None = None) -> DataFrame:
        """Newest first."""
        rows = self.rows.read() if self.rows.refresh().exists() else self.spark.createDataFrame([], self.SCHEMA)
        return (rows if name is None else rows.where(F.col("table_name") == name)).orderBy(F.desc("refreshed_at"), F.desc("batch_id"))


def consume(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint_path: str,
            processing_time: str | None = None, audit: tuple[RefreshAudit, str] | None = None):
    """Run ``on_batch`` for every new micro-batch. Without a processing time: process what is there and
    return a refresh-history record (T11: batches, input rows), which also goes to the ``audit`` table under the given
    name. With one (the target lag): return the running query."""
    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_path)
    if processing_time:
        return _start(w, processing_time)
    batches = _run(stream.sparkSession, w)
    if audit:
        audit[0].record(audit[1], batches)
    return {"batches": [b[0] for b in batches if b[2] > 0], "rows": rows_in(batches), "history": batches}


def incremental_map(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target,
                    checkpoint_path: str, processing_time: str | None = None):
    """Dynamic table over a map-only / stream-static plan: each batch is transformed and appended
    (``target``: ``AppendTable`` or ``SnapshotTable``). The report counts the appended rows
    with an ``Observation`` on the write (no second pass)."""
    appended = []

    def on_batch(df: DataFrame, batch_id: int) -> None:
        # new-data gate: the file stream runs no batch at all when no new file arrived, and each
        # batch is read once (a second action would read the source again and count it twice)
        if hasattr(target, "has_batch") and target.has_batch(batch_id):
            return                              # a replayed batch is in the table already
        obs = Observation(f"appended_{batch_id}")
        if target.append(transform(df).observe(obs, F.count(F.lit(1)).alias("n")), batch_id=batch_id):
            appended.append(int(obs.get["n"]))
    rep = consume(stream, on_batch, checkpoint_path, processing_time)
    if not processing_time:
        rep["appended"] = sum(appended)
    return rep


class RestatedTable:
    """Dynamic table over ``transform(rows, dimensions)`` that always shows the newest dimensions.

    New rows are kept by batch and transformed once with the dimensions of the moment. When a dimension has
    a new version, the refresh transforms all kept rows again and publishes them as a new version.
    The marker of a combination of dimension versions is written last, so a refresh that failed is
    repeated; batches are keyed by their id on both sides, so none is added twice."""

    def __init__(self, spark: SparkSession, root: str, transform: Callable[[DataFrame, dict[str, DataFrame]], DataFrame],
                 dimensions: dict[str, SnapshotTable]):
        self.spark, self.root = spark, root.rstrip("/")
        self.transform, self.dimensions = transform, dimensions
        self.rows = AppendTable(spark, f"{self.root}/rows")
        self.table = SnapshotTable(spark, f"{self.root}/table")

    def refresh(self, stream: DataFrame) -> dict:
        """Take in what is new; ``restated`` tells whether older rows were transformed again."""
        versions = {n: d.refresh().current_version() for n, d in sorted(self.dimensions.items())}
        shown = f"{self.root}/shown/" + ",".join(f"{n}={v}" for n, v in versions.items())
        known = path_exists(self.spark, shown)
        restate = self.table.exists() and not known
        of = lambda rows: self.transform(rows, {n: d.read(versions[n]) for n, d in self.dimensions.items()})

        def on_batch(df: DataFrame, batch_id: int) -> None:
            self.rows.append(df, batch_id=batch_id)
            if not restate:
                self.table.append(of(self.rows.batch(batch_id)), batch_id=batch_id)
        report = consume(stream, on_batch, f"{self.root}/_ckpt")
        if restate:
            self.table.publish(of(self.rows.read()))
        if not known:
            write_marker(self.spark, shown)
        return report | {"restated": restate}

    def read(self) -> DataFrame:
        return self.table.read()


ROW_ID = "row_id"


class MaintainedJoin:
    """Dynamic table over a join of append-only facts with dimension tables, kept up from both sides.

    Facts get a ``row_id`` and are kept, clustered by ``cluster`` (a column they are joined by). ``transform(facts,
    dimensions)`` is the join; it keeps ``row_id`` and the cluster columns. A refresh takes three steps:

    1. A batch that is kept but not shown (an earlier refresh failed in between) is shown first, with the dimension
       versions shown so far.
    2. Of each dimension the change rows since the version shown are read. Facts that meet a value of the join column
       that some changed row has now or had before are joined again; their old results are taken out and the new ones
       put in, in one version of the table. Files without such a row stay.
    3. New facts are kept and their results appended, each batch once.

    ``dimensions``: name -> (ManifestTable, its key columns, join column of the facts, join column of the dimension)."""

    def __init__(self, spark: SparkSession, root: str, transform: Callable[[DataFrame, dict[str, DataFrame]], DataFrame],
                 dimensions: dict[str, tuple[ManifestTable, list[str], str, str]], cluster: list[str], **options):
        self.spark, self.root = spark, root.rstrip("/")
        self.transform, self.dimensions, self.cluster = transform, dimensions, cluster
        self.facts = ManifestTable(spark, f"{self.root}/facts", cluster, **options)
        self.table = ManifestTable(spark, f"{self.root}/table", cluster, **options)

    def _shown(self, name: str) -> int:
        return newest_marker(self.spark, f"{self.root}/shown/{name}")

    def _joined(self, facts: DataFrame, versions: dict[str, int]) -> DataFrame:
        return self.transform(facts, {n: d[0].read(versions[n]) for n, d in self.dimensions.items()})

    def _show_batch(self, batch_key: str, versions: dict[str, int]) -> None:
        if not self.table.refresh().has_batch(batch_key):
            self.table.append(self._joined(self.facts.batch(batch_key), versions), batch_key=batch_key)

    def _restate(self, before: dict[str, int], versions: dict[str, int]) -> dict:
        parts = []
        for name, (dimension, keys, fact_col, dim_col) in self.dimensions.items():
            if before[name] < versions[name]:
                changed = dimension.changes(before[name], versions[name], keys)
                values = changed.select(F.col(dim_col).alias(fact_col)).where(F.col(fact_col).isNotNull()).distinct()
                known = self.facts.read()
                if fact_col in self.cluster:        # only files whose range meets a changed value
                    known = self.facts.read_files(self.facts.touched_files(values, [fact_col], prune=self.cluster == [fact_col]))
                parts.append(known.join(values, fact_col, "left_semi"))
        if not parts:
            return {"deleted": 0, "inserted": 0}
        concerned = parts[0]
        for part in parts[1:]:
            concerned = concerned.unionByName(part)
        concerned = concerned.dropDuplicates([ROW_ID])
        label = ",".join(f"{n}={v}" for n, v in sorted(versions.items()))
        return self.table.replace_keys(concerned, self._joined(concerned, versions), [*self.cluster, ROW_ID], batch_key=f"dimensions:{label}")

    def refresh(self, stream: DataFrame) -> dict:
        """Take in what is new on either side; ``restated`` counts the results taken out and put in again."""
        versions = {n: d[0].refresh().current_version() for n, d in sorted(self.dimensions.items())}
        before = {n: self._shown(n) for n in versions}
        restated = {"deleted": 0, "inserted": 0}
        if self.facts.exists():
            shown = {e["batch"] for e in self.table.refresh().log.entries}
            for entry in self.facts.log.entries:
                if entry["batch"] not in shown:
                    self._show_batch(entry["batch"], before)
            restated = self._restate(before, versions)
        for name, version in versions.items():
            if version > before[name]:
                write_marker(self.spark, f"{self.root}/shown/{name}/{version}")

        def on_batch(df: DataFrame, batch_id: int) -> None:
            key = f"batch:{batch_id}"
            if not self.facts.refresh().has_batch(key):
                self.facts.append(df.withColumn(ROW_ID, F.concat(F.lit(f"{batch_id}-"), F.monotonically_increasing_id())), batch_key=key)
            self._show_batch(key, versions)
        return consume(stream, on_batch, f"{self.root}/_ckpt") | {"restated": restated}

    def read(self) -> DataFrame:
        return self.table.refresh().read().drop(ROW_ID)


class MaintainedAggregate:
    """Dynamic aggregate over a keyed table that also changes rows: sums by ``keys``, kept from signed change rows.

    A refresh reads the net change rows since the stored offset; an INSERT image counts +1, a DELETE image -1. Their
    sums per group are merged into the kept sums by addition. A group keeps its number of rows, and per sum
    the number of values: a group without rows disappears, a sum without values is NULL. A batch of
    changes that is offered again is not added twice. NULL is a group value like others."""

    GROUP, ROWS = "__group", "__rows"

    def __init__(self, spark: SparkSession, root: str, source: ManifestTable, source_keys: list[str], keys: list[str], sum_cols: list[str],
                 of: Callable[[DataFrame], DataFrame] = lambda df: df, **options):
        self.keys, self.sum_cols, self.of = keys, sum_cols, of
        self.kept = ManifestTable(spark, f"{root.rstrip('/')}/kept", [self.GROUP], **options)
        self.feed = ChangeFeed(source, f"{root.rstrip('/')}/_offset", source_keys)

    def _delta(self, images: DataFrame) -> DataFrame:
        sign = F.when(F.col(ACTION) == "INSERT", 1).otherwise(-1)
        rows = self.of(images)
        sums = [F.sum(F.coalesce(F.col(c), F.lit(0)) * sign).alias(c) for c in self.sum_cols]
        counts = [F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"__n_{c}") for c in self.sum_cols]
        delta = rows.groupBy(*self.keys).agg(*sums, *counts, F.sum(sign).alias(self.ROWS))
        # NULL parts are left out of the text, so it names every group
        return delta.withColumn(self.GROUP, F.to_json(F.struct(*self.keys)))

    def refresh(self) -> dict | None:
        """Rows of the summary updated and inserted; None: nothing new."""
        added = [*self.sum_cols, *[f"__n_{c}" for c in self.sum_cols], self.ROWS]

        def apply(images: DataFrame, version: int) -> dict:
            return self.kept.merge(self._delta(images), [self.GROUP], added, combine={c: (lambda t, s: t + s) for c in added},
                                   on_duplicate="unique", keep=F.col(self.ROWS) != 0, batch_key=f"upto:{version}")
        return self.feed.consume(apply)

    def read(self) -> DataFrame:
        sums = [F.when(F.col(f"__n_{c}") != 0, F.col(c)).alias(c) for c in self.sum_cols]
        return self.kept.refresh().read().select(*self.keys, *sums)


def additive_merge(current: DataFrame | None, delta: DataFrame, keys: list[str], sum_cols: list[str]) -> DataFrame:
    """Summary after adding ``delta``: sums are additive, so union + re-aggregate by key."""
    both = delta if current is None else current.select(*keys, *sum_cols).unionByName(delta.select(*keys, *sum_cols))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sum_cols])


def incremental_aggregate(stream: DataFrame, delta_of: Callable[[DataFrame], DataFrame],
                          keys: list[str], sum_cols: list[str], target, checkpoint_path: str,
                          processing_time: str | None = None, audit: tuple[RefreshAudit, str] | None = None):
    """Dynamic aggregate table kept at fact grain keys (e.g. date x product id).

    ``delta_of(batch)`` gives the batch's partial sums by ``keys``; they are merged additively.
    With a ``PartitionedTable`` target the delta is merged into the touched partitions only
    (matched keys add, new keys insert); with a ``SnapshotTable`` the summary is re-aggregated
    with the delta and published as a new version. Descriptive dimension columns (name, category
    of the *current* version) are joined when the summary is read, so a dimension change needs
    no re-aggregation of facts.
    """
    def on_batch(df: DataFrame, batch_id: int) -> None:
        delta = delta_of(df)
        if hasattr(target, "merge"):
            target.merge(delta, keys, sum_cols, combine={c: (lambda t, s: t + s) for c in sum_cols},
                         on_duplicate="unique",   # the delta is an aggregate by ``keys``
                         batch_key=f"{checkpoint_path}#{batch_id}")   # a replayed batch is not added again
        else:
            current = target.read() if target.exists() else None
            target.publish(additive_merge(current, delta, keys, sum_cols), batch_id=batch_id)
    return consume(stream, on_batch, checkpoint_path, processing_time, audit)

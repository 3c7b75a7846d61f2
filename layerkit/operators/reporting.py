"""Reports over log relations: recent top-k, daily load, newest-first event log, run log and
its summary message."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def recent(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """``to_date(ts) > dateadd(day, -days, to_date(as_of))`` (``as_of`` None = now)."""
    ref = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return df.filter(F.to_date(F.col(ts_col)) > F.date_sub(ref, days))


def topk_recent(df: DataFrame, ts_col: str, metric_col: str, k: int, as_of, days: int = 1,
                tie_cols: list[str] | None = None) -> DataFrame:
    """Slowest statements of the last day, top k: filter then ``orderBy.limit`` (TakeOrderedAndProject:
    each task keeps its own top k, the driver merges k per task)."""
    order = [F.col(metric_col).desc()] + [F.col(c).asc() for c in (tie_cols or [])]
    return recent(df, ts_col, as_of, days).orderBy(*order).limit(k)


def daily_report(df: DataFrame, ts_col: str, name_col: str, sums: dict[str, Column], as_of, days: int) -> DataFrame:
    """Sums per calendar day and name over the last ``days`` days, ordered by day, name."""
    r = recent(df, ts_col, as_of, days)
    return (r.groupBy(F.to_date(F.col(ts_col)).alias("day"), F.col(name_col).alias(name_col))
            .agg(*[e.alias(n) for n, e in sums.items()])
            .orderBy("day", name_col))


def newest_first(df: DataFrame, ts_col: str, id_col: str) -> DataFrame:
    return df.orderBy(F.col(ts_col).desc(), F.col(id_col).asc())


class MessageLog:
    """Append-only log of messages (event_id, ts, severity, message); several writers may append."""

    def __init__(self, spark: SparkSession, root: str):
        from ..sources.snapshot import SnapshotTable
        self.rows = SnapshotTable(spark, root)

    def append(self, messages: DataFrame) -> None:
        self.rows.refresh().append(messages.select("event_id", "ts", "severity", "message"))

    def log(self, message: str, severity: str = "INFO") -> None:
        """One message, now."""
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        one = self.rows.spark.createDataFrame([(uuid.uuid4().int >> 65, now, severity, message)], "event_id long, ts timestamp_ntz, severity string, message string")
        self.append(one.coalesce(1))

    def read(self) -> DataFrame:
        return self.rows.refresh().read()


# ---------------------------------------------------------------------------- run log
# Names and order of the log's columns (fixed values)
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_group_id", T.StringType()),
    T.StructField("root_task_name", T.StringType()),
    T.StructField("task_name", T.StringType()),
    T.StructField("log_ts", T.TimestampType()),
    T.StructField("rows_processed", T.DecimalType(38, 0)),
])


class RunLog:
    """Append-only run log (``insert into PIPELINE_LOG select run id, root, task, now, rowcount``)."""

    def __init__(self, spark: SparkSession, path: str, root_task: str, run_group_id: str | None = None):
        self.spark, self.path, self.root_task = spark, path.rstrip("/"), root_task
        self.run_group_id = run_group_id or uuid.uuid4().hex
        self._last = None
        self._seq = 0

    def log_step(self, task_name: str, rows_processed: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if self._last is not None and now <= self._last:   # keep log_ts strictly increasing within a run
            now = self._last + _dt.timedelta(microseconds=1)
        self._last = now
        row = [(self.run_group_id, self.root_task, task_name, now, int(rows_processed))]
        from decimal import Decimal
        row = [(a, b, c, d, Decimal(e)) for a, b, c, d, e in row]
        self._seq += 1
        # one file per logged step, written under the run's folder: a retried step rewrites it
        (self.spark.createDataFrame(row, RUN_LOG_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/run={self.run_group_id}/step={self._seq:04d}"))

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)


def run_summary_message(log: DataFrame, run_group_id: str | Column | None = None) -> DataFrame:
    """One line per step of a run: ``Task: <task> Rows processed: <n> `` + newline, in log order.

    ``listagg`` over the steps of one run: the group is one run's steps (a handful of rows).
    """
    rows = log if run_group_id is None else log.filter(F.col("run_group_id") == run_group_id)
    line = F.concat(F.lit("Task: "), F.col("task_name"), F.lit(" Rows processed: "),
                    F.col("rows_processed").cast("string"), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("log_ts"), F.col("task_name"), line.alias("line"))))
    return (rows.groupBy("run_group_id")
            .agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "").alias("message")))


def run_summary_message_sql(spark: SparkSession, log: DataFrame, run_group_id: str) -> DataFrame:
    """The same text with ``listagg ... within group (order by log_ts, task_name)`` in Spark SQL."""
    log.createOrReplaceTempView("pipeline_log")
    return spark.sql("""
        select listagg('Task: ' || task_name || ' Rows processed: ' || cast(rows_processed as string) || '\\n', '')
                 within group (order by log_ts, task_name) as message
        from pipeline_log where run_group_id = :run""", args={"run": run_group_id})

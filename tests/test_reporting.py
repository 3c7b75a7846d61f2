import datetime as dt
import os

from pyspark.sql import functions as F

from layerkit.operators.layout import cluster_by, layout_report
from layerkit.operators.reporting import RunLog, run_summary_message, topk_recent


def test_run_log_and_summary_message(spark, tmp_area):
    log = RunLog(spark, f"{tmp_area}/log", "ROOT")
    for task, n in [("COPY", 1), ("INSERT_STG", 9), ("COPY", 0)]:
        log.log_step(task, n)
    other = RunLog(spark, f"{tmp_area}/log", "ROOT")
    other.log_step("COPY", 5)
    msg = run_summary_message(log.read(), log.run_group_id).first().message
    assert msg == "Task: COPY Rows processed: 1\nTask: INSERT_STG Rows processed: 9\nTask: COPY Rows processed: 0\n"


def test_topk_recent(spark):
    rows = [(i, dt.datetime(2024, 1, 30 - (i % 5)), float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double")
    got = topk_recent(df, "ts", "v", 3, dt.date(2024, 1, 31), 2, ["id"]).collect()
    want = sorted([r for r in rows if r[1].date() > dt.date(2024, 1, 29)], key=lambda r: (-r[2], r[0]))[:3]
    assert [r.id for r in got] == [r[0] for r in want]


def test_clustering_gives_disjoint_files(spark, tmp_area):
    df = spark.range(0, 20000).selectExpr("id % 997 as k", "id as v")
    path = f"{tmp_area}/clustered"
    cluster_by(df, path, ["k"], num_files=8)
    r = layout_report(spark, path, "k").first()
    assert r.total_files >= 2 and r.max_depth <= 2


def test_reused_result_is_released(spark):
    from layerkit.operators.reuse import reused
    df = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    with reused(df) as r:
        assert r.is_cached and r.count() == 7 and r.agg({"count": "sum"}).first()[0] == 1000
    assert not df.is_cached


def test_run_summary_message_sql_form(spark, tmp_area):
    from layerkit.operators.reporting import run_summary_message_sql
    log = RunLog(spark, f"{tmp_area}/log2", "ROOT")
    log.log_step("A", 3)
    log.log_step("B", 4)
    df = log.read()
    assert (run_summary_message_sql(spark, df, log.run_group_id).first().message
            == run_summary_message(df, log.run_group_id).first().message
            == "Task: A Rows processed: 3\nTask: B Rows processed: 4\n")


def test_shuffle_partitions_sized_from_input(spark):
    from layerkit.session import size_shuffle_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle_partitions(spark, 100 * 2 ** 40) == 409600
        assert size_shuffle_partitions(spark, 10) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_layout_report_overlaps_and_depth(spark, tmp_area):
    # three files with key ranges [0,10], [5,15], [20,20]
    for i, (lo, hi) in enumerate([(0, 10), (5, 15), (20, 20)]):
        spark.createDataFrame([(lo,), (hi,)], "k int").coalesce(1).write.mode("append").parquet(f"{tmp_area}/files")
    r = layout_report(spark, f"{tmp_area}/files", "k").first()
    assert (r.total_files, r.constant_files, r.max_depth) == (3, 1, 2)
    assert abs(r.average_overlaps - 2 / 3) < 1e-9      # files 1 and 2 overlap each other


def test_layout_files_are_written_by_several_tasks(spark):
    from .conftest import SF001
    from layerkit.plans.q_misc import _overlapping_files
    files = spark.read.parquet(_overlapping_files(spark, SF001)).select("g", F.input_file_name().alias("f")).distinct().collect()
    assert len({r["g"] for r in files}) == len(files)                    # one file for each group
    assert len({r["f"].split("/part-")[1][:5] for r in files}) > 1       # not all from one task

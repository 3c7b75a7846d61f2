import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from layerkit.sources.snapshot import AppendTable, SnapshotTable
from layerkit.sources.stage import ORDER_LINE_SCHEMA, FileFormat, read_stage, stage_listing
from layerkit.streaming.incremental import change_stream, incremental_map
from layerkit.streaming.ingest import FileIngest

HEADER = "Customer,Order date,Delivery date,Baked good type,Quantity\n"


def csv_file(path, name, lines, newline_at_end=True):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(HEADER + "\n".join(lines) + ("\n" if newline_at_end else ""))


def test_copy_loads_each_file_once(spark, local_dir, tmp_area):
    stage = os.path.join(local_dir, "stage")
    csv_file(stage, "Orders_1.csv", ["Cafe's Corner,2023-07-07,2023-07-10,Bagel,12", "Cafe B,2023-07-07,2023-07-10,Roll,3"])
    ing = FileIngest(spark, stage, f"{tmp_area}/t", f"{tmp_area}/ck", FileFormat.csv(), ORDER_LINE_SCHEMA)
    assert ing.run() == 2
    assert ing.run() == 0                      # nothing new: nothing appended
    csv_file(stage, "Orders_2.csv", ["Cafe B,2023-07-08,2023-07-11,Roll,4"], newline_at_end=False)
    assert ing.run() == 1
    rows = ing.read().collect()
    assert len(rows) == 3
    assert sorted({r.source_file_name for r in rows}) == ["Orders_1.csv", "Orders_2.csv"]
    assert {r.customer for r in rows} >= {"Cafe's Corner"}


def test_abort_on_bad_rows(spark, local_dir):
    stage = os.path.join(local_dir, "bad")
    csv_file(stage, "x.csv", ["Cafe,2023-13-45,2023-07-10,Bagel,1"])
    with pytest.raises(Exception):
        read_stage(spark, stage, ORDER_LINE_SCHEMA, FileFormat.csv(on_error="abort")).collect()
    stage2 = os.path.join(local_dir, "short")
    csv_file(stage2, "y.csv", ["Cafe,2023-07-07"])
    with pytest.raises(Exception):
        read_stage(spark, stage2, ORDER_LINE_SCHEMA, FileFormat.csv(on_error="abort")).collect()


def test_scoped_load_and_listing(spark, local_dir):
    stage = os.path.join(local_dir, "st")
    csv_file(os.path.join(stage, "202307"), "a.csv", ["A,2023-07-07,2023-07-10,Bagel,1"])
    csv_file(os.path.join(stage, "202308"), "b.csv", ["B,2023-08-07,2023-08-10,Bagel,2", "C,2023-08-07,2023-08-10,Roll,3"])
    df = read_stage(spark, stage, ORDER_LINE_SCHEMA, FileFormat.csv(), sub_path="202308")
    assert df.count() == 2 and {r.source_file_name for r in df.collect()} == {"202308/b.csv"}
    assert stage_listing(spark, stage).count() == 2


def test_snapshot_versions_and_replayed_batch(spark, tmp_area):
    t = SnapshotTable(spark, tmp_area)
    v1 = t.publish(spark.createDataFrame([(1,)], "a int"), batch_id=0)
    v2 = t.append(spark.createDataFrame([(2,)], "a int"), batch_id=1)
    v3 = t.append(spark.createDataFrame([(2,)], "a int"), batch_id=1)    # replay: skipped
    assert (v1, v2, v3) == (1, 2, 2)
    assert sorted(r.a for r in t.read().collect()) == [1, 2]
    assert sorted(r.a for r in t.read(1).collect()) == [1]


def test_incremental_equals_full_after_each_batch(spark, tmp_area):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    src, dst = AppendTable(spark, f"{tmp_area}/src"), AppendTable(spark, f"{tmp_area}/dst")
    for b in range(3):
        src.append(spark.createDataFrame([(b * 10 + i, i) for i in range(5)], schema), batch_id=b)
        rep = incremental_map(change_stream(spark, src.root, schema), lambda df: df.filter("v % 2 = 0"),
                              dst, f"{tmp_area}/ck")
        assert rep["appended"] == 3
        assert sorted(dst.read().collect()) == sorted(src.read().filter("v % 2 = 0").collect())


def test_continuous_pipe_picks_up_new_files(spark, local_dir, tmp_area):
    stage = os.path.join(local_dir, "pipe")
    csv_file(stage, "a.csv", ["A,2023-07-07,2023-07-10,Bagel,1"])
    ing = FileIngest(spark, stage, f"{tmp_area}/t", f"{tmp_area}/ck", FileFormat.csv(), ORDER_LINE_SCHEMA)
    q = ing.start_continuous("1 second")
    try:
        q.processAllAvailable()
        csv_file(stage, "b.csv", ["B,2023-07-07,2023-07-10,Roll,2"])
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.customer for r in ing.read().collect()) == ["A", "B"]


def test_incremental_aggregate_equals_full_recompute(spark, tmp_area):
    from pyspark.sql import functions as F

    from layerkit.sources.partitioned import PartitionedTable
    from layerkit.streaming.incremental import incremental_aggregate
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("pid", T.LongType()),
                           T.StructField("q", T.LongType())])
    facts = AppendTable(spark, f"{tmp_area}/facts")
    summary = PartitionedTable(spark, f"{tmp_area}/summary", "m", F.date_format("day", "yyyy-MM"))
    for b in range(3):
        rows = [(dt.date(2023, 1 + (i + b) % 3, 1 + i % 5), i % 4, i + b) for i in range(20)]
        facts.append(spark.createDataFrame(rows, schema), batch_id=b)
        incremental_aggregate(facts.stream(schema), lambda df: df.groupBy("day", "pid").agg(F.sum("q").alias("q")),
                              ["day", "pid"], ["q"], summary, f"{tmp_area}/ck")
        full = facts.read().groupBy("day", "pid").agg(F.sum("q").alias("q"))
        assert sorted(summary.read().drop("m").collect()) == sorted(full.collect())


def test_external_view_refresh_sees_new_files(spark, local_dir):
    from layerkit.sources.stage import create_external_view, refresh_external_view
    stage = os.path.join(local_dir, "ext")
    csv_file(stage, "a.csv", ["A,2023-07-07,2023-07-10,Bagel,1"])
    v = create_external_view(spark, "orders_ext_t", stage, ORDER_LINE_SCHEMA, FileFormat.csv())
    assert v.count() == 1
    csv_file(stage, "b.csv", ["B,2023-07-07,2023-07-10,Roll,2"])
    refresh_external_view(spark, "orders_ext_t")
    assert spark.table("orders_ext_t").count() == 2


def test_replayed_batch_after_failure_is_not_duplicated(spark, local_dir, tmp_area):
    stage = os.path.join(local_dir, "replay")
    csv_file(stage, "a.csv", ["A,2023-07-07,2023-07-10,Bagel,1", "B,2023-07-07,2023-07-10,Roll,2"])
    ing = FileIngest(spark, stage, f"{tmp_area}/unused", f"{tmp_area}/ck", FileFormat.csv(), ORDER_LINE_SCHEMA)
    out = AppendTable(spark, f"{tmp_area}/out")
    seen = []

    def crash_after_write(df, batch_id):
        out.append(df.select(*ORDER_LINE_SCHEMA.names), batch_id=batch_id)
        seen.append(batch_id)
        raise RuntimeError("lost after the write, before the batch committed")

    with pytest.raises(Exception):
        ing.run_each(crash_after_write)
    ing.run_each(lambda df, b: (seen.append(b), out.append(df.select(*ORDER_LINE_SCHEMA.names), batch_id=b)))
    assert seen[0] == seen[1]                    # the same batch was replayed
    assert sorted(r.customer for r in out.read().collect()) == ["A", "B"]   # and written once


def test_stage_root_without_scheme():
    from layerkit.sources.stage import _strip_scheme
    assert _strip_scheme("file:/tmp/a") == "/tmp/a"
    assert _strip_scheme("file:///tmp/a") == "/tmp/a"
    assert _strip_scheme("hdfs://nn:8020/data/stage") == "/data/stage"
    assert _strip_scheme("s3a://bucket/landing/orders") == "/landing/orders"
    assert _strip_scheme("/plain/path") == "/plain/path"


def test_snapshot_compaction(spark, tmp_area):
    t = SnapshotTable(spark, f"{tmp_area}/c")
    t.publish(spark.createDataFrame([(1,)], "a int"))
    for i in range(2, 5):
        t.append(spark.createDataFrame([(i,)], "a int"))
    v = t.compact(num_files=1)
    assert v == 5 and sorted(r.a for r in t.read().collect()) == [1, 2, 3, 4]
    assert t.read().inputFiles() and len(t.read().inputFiles()) == 1

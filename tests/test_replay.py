"""State that must survive NULL partitions, replayed batches, moved rows and many batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from layerkit.sources.commits import CommitLog
from layerkit.sources.partitioned import PartitionedTable
from layerkit.sources.snapshot import AppendTable
from layerkit.sources.stage import FileFormat
from layerkit.streaming.incremental import change_stream, consume, incremental_aggregate, incremental_map
from layerkit.streaming.ingest import FileIngest

D = dt.date


def month_table(spark, path):
    return PartitionedTable(spark, path, "m", F.date_format("day", "yyyy-MM"))


SCH = "day date, id string, q bigint"


def rows(t):
    return sorted((str(r.day), r.id, r.q) for r in t.read().collect())


def test_null_partition_keeps_its_rows(spark, tmp_area):
    t = month_table(spark, f"{tmp_area}/n")
    t.merge(spark.createDataFrame([(None, "a", 1), (D(2030, 1, 1), "b", 2)], SCH), ["day", "id"], ["q"])
    t.merge(spark.createDataFrame([(None, "c", 3)], SCH), ["day", "id"], ["q"])
    assert rows(t) == [("2030-01-01", "b", 2), ("None", "a", 1), ("None", "c", 3)]
    assert t.update_where(F.col("id") == "a", {"q": F.lit(9).cast("bigint")}) == 1
    assert rows(t) == [("2030-01-01", "b", 2), ("None", "a", 9), ("None", "c", 3)]


def test_tables_without_success_files(spark, tmp_area):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        t = month_table(spark, f"{tmp_area}/s")
        t.merge(spark.createDataFrame([(D(2030, 1, 1), "a", 1)], SCH), ["day", "id"], ["q"])
        t.merge(spark.createDataFrame([(D(2030, 2, 1), "b", 2)], SCH), ["day", "id"], ["q"])
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(t) == [("2030-01-01", "a", 1), ("2030-02-01", "b", 2)]


def test_partition_values_keep_their_type(spark, tmp_area):
    t = PartitionedTable(spark, f"{tmp_area}/t", "p", F.col("id"))
    t.merge(spark.createDataFrame([(D(2030, 1, 1), "007", 1)], SCH), ["id"], ["q"])
    assert t.merge(spark.createDataFrame([(D(2030, 1, 1), "007", 5)], SCH), ["id"], ["q"]) == {"updated": 1, "inserted": 0}
    assert rows(t) == [("2030-01-01", "007", 5)]


def test_update_moves_rows_between_partitions(spark, tmp_area):
    t = month_table(spark, f"{tmp_area}/m")
    t.merge(spark.createDataFrame([(D(2030, 1, 1), "a", 1), (D(2030, 2, 1), "b", 2), (D(2030, 3, 1), "c", 3)], SCH), ["day", "id"], ["q"])
    assert t.update_where(F.col("id").isin("a", "b"), {"day": F.lit(D(2030, 3, 5))}) == 2
    assert rows(t) == [("2030-03-01", "c", 3), ("2030-03-05", "a", 1), ("2030-03-05", "b", 2)]
    assert t.read().filter("m in ('2030-01', '2030-02')").count() == 0
    assert t.merge(spark.createDataFrame([(D(2030, 3, 5), "a", 8)], SCH), ["day", "id"], ["q"]) == {"updated": 1, "inserted": 0}


@pytest.mark.parametrize("fail_at", ["after the merge", "before the commit"])
def test_replayed_batch_is_added_once(spark, tmp_area, fail_at, monkeypatch):
    facts = AppendTable(spark, f"{tmp_area}/facts")
    total = month_table(spark, f"{tmp_area}/sum")
    facts.append(spark.createDataFrame([(D(2030, 1, 1), "a", 4), (D(2030, 2, 1), "a", 6)], SCH), batch_id=0)
    state = {"fail": True}
    if fail_at == "after the merge":
        real = PartitionedTable.merge

        def merge(self, *a, **k):
            out = real(self, *a, **k)
            if state.pop("fail", False):
                raise RuntimeError("lost before the commit")
            return out
        monkeypatch.setattr(PartitionedTable, "merge", merge)
    else:
        real = CommitLog.commit

        def commit(self, entry):
            if self is total.log and state.pop("fail", False):
                raise RuntimeError("lost before the commit")
            return real(self, entry)
        monkeypatch.setattr(CommitLog, "commit", commit)

    def run():
        return incremental_aggregate(facts.stream(spark.createDataFrame([], SCH).schema),
                                     lambda df: df.groupBy("day", "id").agg(F.sum("q").alias("q")), ["day", "id"], ["q"], total, f"{tmp_area}/_c")
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert rows(total) == [("2030-01-01", "a", 4), ("2030-02-01", "a", 6)]
    facts.append(spark.createDataFrame([(D(2030, 1, 1), "a", 1)], SCH), batch_id=1)
    run()
    assert rows(total) == [("2030-01-01", "a", 5), ("2030-02-01", "a", 6)]


def test_consumer_of_a_replayed_batch_sees_it_once(spark, tmp_area, monkeypatch):
    schema = spark.createDataFrame([], SCH).schema
    source, middle, sink = (AppendTable(spark, f"{tmp_area}/{n}") for n in ("source", "middle", "sink"))
    source.append(spark.createDataFrame([(D(2030, 1, i), "a", i) for i in range(1, 6)], SCH), batch_id=0)
    real, state = AppendTable.append, {"fail": True}

    def append(self, df, *, batch_id):
        out = real(self, df, batch_id=batch_id)
        if self.root.endswith("middle") and state.pop("fail", False):
            raise RuntimeError("lost before the commit")
        return out
    monkeypatch.setattr(AppendTable, "append", append)

    def first():
        return incremental_map(change_stream(spark, source.root, schema), lambda d: d, middle, f"{tmp_area}/_c1")

    def second():
        return incremental_map(middle.stream(schema), lambda d: d, sink, f"{tmp_area}/_c2")
    with pytest.raises(Exception, match="lost"):
        first()
    second()
    first()
    second()
    assert source.read().count() == middle.read().count() == sink.read().count() == 5


def test_every_batch_is_counted(spark, tmp_area, local_dir):
    for i in range(150):
        with open(os.path.join(local_dir, f"f {i:03d}.csv"), "w") as f:
            f.write(f"h\n{i}\n")
    copy = FileIngest(spark, local_dir, f"{tmp_area}/t", f"{tmp_area}/_c", FileFormat.csv(),
                      schema=spark.createDataFrame([], "h int").schema, max_files_per_trigger=1)
    assert copy.run() == 150 and copy.read().count() == 150
    assert copy.run() == 0


def test_purge_leaves_what_was_delivered_again(spark, tmp_area, local_dir, monkeypatch):
    def deliver(name, *lines):
        with open(os.path.join(local_dir, name), "w") as f:
            f.write("\n".join(["h", *lines, ""]))
    for i in range(40):
        deliver(f"f {i:02d}+.csv", str(i))
    copy = FileIngest(spark, local_dir, f"{tmp_area}/t", f"{tmp_area}/_c", FileFormat.csv(), schema=spark.createDataFrame([], "h int").schema, purge=True)
    real = FileIngest._purge_batches

    def late(self, noted, since):
        deliver("f 07+.csv", "700", "701")               # after the load, before the purge, under a loaded name
        deliver("new.csv", "9")
        return real(self, noted, since)
    monkeypatch.setattr(FileIngest, "_purge_batches", late)
    assert copy.run() == 40
    assert sorted(n for n in os.listdir(local_dir) if n.endswith(".csv") and n[0] != ".") == ["f 07+.csv", "new.csv"]


def test_target_lag_returns_the_running_query(spark, tmp_area):
    schema = spark.createDataFrame([], SCH).schema
    source = AppendTable(spark, f"{tmp_area}/src")
    source.append(spark.createDataFrame([(D(2030, 1, 1), "a", 1)], SCH), batch_id=0)
    out = AppendTable(spark, f"{tmp_area}/out")
    q = incremental_map(change_stream(spark, source.root, schema), lambda d: d, out, f"{tmp_area}/_c", processing_time="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive and out.read().count() == 1
    finally:
        q.stop()


def test_history_has_every_batch(spark, tmp_area):
    schema = spark.createDataFrame([], SCH).schema
    source = AppendTable(spark, f"{tmp_area}/src")
    for i in range(3):
        source.append(spark.createDataFrame([(D(2030, 1, 1), "a", i)], SCH).coalesce(1), batch_id=i)
    rep = consume(change_stream(spark, source.root, schema, max_files_per_trigger=1), lambda d, b: d.count(), f"{tmp_area}/_c")
    assert rep["rows"] == 3 and [h[0] for h in rep["history"] if h[2]] == [0, 1, 2]


def test_purge_takes_files_without_rows(spark, tmp_area, local_dir):
    def deliver(name, *lines):
        with open(os.path.join(local_dir, name), "w") as f:
            f.write("".join(line + "\n" for line in lines))
    copy = FileIngest(spark, local_dir, f"{tmp_area}/t", f"{tmp_area}/_c", FileFormat.csv(), schema=spark.createDataFrame([], "h int").schema, purge=True)
    deliver("only header [a].csv", "h")
    copy.run()
    assert os.listdir(local_dir) == []
    deliver("full.csv", "h", "1")
    deliver("header b.csv", "h")
    copy.run()
    assert os.listdir(local_dir) == [] and copy.read().count() == 1
    deliver("full.csv", "h", "2")                    # a loaded name: not loaded again, so it stays
    copy.run()
    assert os.listdir(local_dir) == ["full.csv"] and copy.read().count() == 1

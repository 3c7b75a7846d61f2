"""Dynamic tables over changing dimensions, and change streams with a stored offset."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.changes import ACTION, ChangeFeed
from layerkit.sources.snapshot import AppendTable, SnapshotTable
from layerkit.streaming.incremental import RestatedTable, change_stream

LINES = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.LongType())])


def lines(spark, path, rows):
    spark.createDataFrame(rows, LINES).write.mode("append").parquet(path)


def keyed(spark, rows):
    return spark.createDataFrame(rows, "code string, label string")


def joined(df, dims):
    return df.join(dims["label"], "code").select("code", "label", "n")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimension_change_restates_older_rows(spark, tmp_area):
    labels = SnapshotTable(spark, f"{tmp_area}/labels")
    out = RestatedTable(spark, f"{tmp_area}/out", joined, {"label": labels})
    labels.publish(keyed(spark, [("a", "old")]))
    lines(spark, f"{tmp_area}/in", [("a", 1), ("b", 2)])
    refresh = lambda: out.refresh(change_stream(spark, f"{tmp_area}/in", LINES))
    assert refresh()["restated"] is False
    assert rows_of(out.read()) == [("a", "old", 1)]
    lines(spark, f"{tmp_area}/in", [("a", 3)])
    assert refresh()["restated"] is False
    assert rows_of(out.read()) == [("a", "old", 1), ("a", "old", 3)]
    labels.publish(keyed(spark, [("a", "new"), ("b", "late")]))
    lines(spark, f"{tmp_area}/in", [("b", 4)])
    assert refresh()["restated"] is True
    expected = [("a", "new", 1), ("a", "new", 3), ("b", "late", 2), ("b", "late", 4)]
    assert rows_of(out.read()) == expected
    assert refresh()["restated"] is False
    assert rows_of(out.read()) == expected


def test_failed_restatement_is_repeated(spark, tmp_area):
    labels = SnapshotTable(spark, f"{tmp_area}/labels")
    labels.publish(keyed(spark, [("a", "old")]))
    lines(spark, f"{tmp_area}/in", [("a", 1)])
    source = lambda: change_stream(spark, f"{tmp_area}/in", LINES)
    RestatedTable(spark, f"{tmp_area}/out", joined, {"label": labels}).refresh(source())
    labels.publish(keyed(spark, [("a", "new")]))
    lines(spark, f"{tmp_area}/in", [("a", 2)])
    failing = RestatedTable(spark, f"{tmp_area}/out", joined, {"label": labels})
    failing.table.publish = lambda df: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        failing.refresh(source())
    again = RestatedTable(spark, f"{tmp_area}/out", joined, {"label": labels})
    assert again.refresh(source())["restated"] is True
    assert rows_of(again.read()) == [("a", "new", 1), ("a", "new", 2)]


def test_feed_offset_gate_and_replay(spark, tmp_area):
    labels, seen = SnapshotTable(spark, f"{tmp_area}/labels"), AppendTable(spark, f"{tmp_area}/seen")
    feed = lambda: ChangeFeed(labels, f"{tmp_area}/offset", ["code"])

    def apply(changes, version):
        seen.append(changes.withColumn("v", F.lit(version)), batch_id=version)
        return version

    assert feed().pending() is None and feed().consume(apply) is None       # no table version yet
    labels.publish(keyed(spark, [("a", "x"), (None, "n")]))
    assert feed().consume(apply) == 1
    assert feed().consume(apply) is None
    labels.publish(keyed(spark, [("a", "y"), (None, "n")]))

    def fails(changes, version):
        apply(changes, version)
        raise RuntimeError("lost after the write")

    with pytest.raises(RuntimeError):
        feed().consume(fails)
    labels.publish(keyed(spark, [("a", "z"), (None, "n")]))
    assert feed().consume(apply) == 2                                       # the failed batch, with its own end
    assert feed().consume(apply) == 3
    got = sorted((r["v"], r[ACTION], r["code"] or "", r["label"]) for r in seen.read().collect())
    assert got == [(1, "INSERT", "", "n"), (1, "INSERT", "a", "x"), (2, "DELETE", "a", "x"), (2, "INSERT", "a", "y"),
                   (3, "DELETE", "a", "y"), (3, "INSERT", "a", "z")]

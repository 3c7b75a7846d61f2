"""State that loads and refreshes keep: copy ledger, stage directory, refresh audit, feeds of dimensions, layout and look-up of
tables kept as files."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.changes import ChangeFeed
from layerkit.operators.history import current_rows, current_versions, validity_intervals
from layerkit.operators.layout import sweep
from layerkit.operators.reporting import MessageLog
from layerkit.plans.q_streaming import version_dimension
from layerkit.sources.manifest import ManifestTable, data_file
from layerkit.sources.snapshot import AppendTable
from layerkit.sources.stage import FileFormat, StageDirectory
from layerkit.streaming.incremental import RefreshAudit
from layerkit.streaming.ledger import LedgerLoad, LoadFailedError

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("q", T.LongType())])


def deliver(folder, name, *lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(["id,q", *lines, ""]))


def ledger(load):
    return [(r.file_name, r.status, r.row_parsed, r.row_count, r.error_count) for r in load.history().collect()]


def load_of(spark, stage, root, on_error="abort"):
    table = ManifestTable(spark, root, ["id"])
    return table, LedgerLoad(spark, stage, table, "orders", SCHEMA, FileFormat.csv(), on_error=on_error)


def test_ledger_of_loads(spark, tmp_area, local_dir):
    deliver(local_dir, "a/x 1.csv", "1,10", "2,20")
    deliver(local_dir, "b.csv", "3,30")
    table, load = load_of(spark, local_dir, f"{tmp_area}/t")
    assert load.run() == {"LOADED": 2, "rows": 3}
    assert load.run() == {"rows": 0} and table.read().count() == 3                  # nothing pending
    assert sorted(ledger(load)) == [("a/x 1.csv", "LOADED", 2, 2, 0), ("b.csv", "LOADED", 1, 1, 0)]
    plan = load.history()
    assert all("/ledger/" in f for f in plan.inputFiles())                         # the target is not read
    deliver(local_dir, "b.csv", "3,30", "4,40")                                    # the same name, new content
    assert load.run() == {"LOADED": 1, "rows": 2} and table.refresh().read().count() == 5
    assert [r[0] for r in ledger(load)][0] == "b.csv"                              # newest first
    assert load.run(force=True)["rows"] == 4


def test_ledger_lists_a_failed_load(spark, tmp_area, local_dir):
    deliver(local_dir, "good.csv", "1,1")
    deliver(local_dir, "bad.csv", "2,2", "3,three", "4,four")
    table, load = load_of(spark, local_dir, f"{tmp_area}/t")
    with pytest.raises(LoadFailedError):
        load.run()
    assert table.refresh().read().count() == 0 and ledger(load) == [("bad.csv", "LOAD_FAILED", 3, 0, 2)]
    assert "three" in load.history().first().first_error or "four" in load.history().first().first_error
    deliver(local_dir, "bad.csv", "2,2", "3,3")
    assert load.run() == {"LOADED": 2, "rows": 3} and table.refresh().read().count() == 3
    assert [r[1] for r in ledger(load)] == ["LOADED", "LOADED", "LOAD_FAILED"]


@pytest.mark.parametrize("on_error, rows, status", [("continue", 2, "PARTIALLY_LOADED"), ("skip_file", 1, "LOAD_FAILED")])
def test_ledger_other_error_rules(spark, tmp_area, local_dir, on_error, rows, status):
    deliver(local_dir, "good.csv", "1,1")
    deliver(local_dir, "bad.csv", "2,2", "3,three")
    table, load = load_of(spark, local_dir, f"{tmp_area}/t", on_error)
    assert load.run()["rows"] == rows and table.read().count() == rows
    assert {r[0]: r[1] for r in ledger(load)} == {"good.csv": "LOADED", "bad.csv": status}


def test_ledger_and_rows_are_published_together(spark, tmp_area, local_dir, monkeypatch):
    from layerkit.sources.commits import CommitLog
    deliver(local_dir, "a.csv", "1,1")
    table, load = load_of(spark, local_dir, f"{tmp_area}/t")
    real, state = CommitLog.commit, {"fail": True}

    def commit(self, entry):
        if state.pop("fail", False):
            raise RuntimeError("lost")
        return real(self, entry)
    monkeypatch.setattr(CommitLog, "commit", commit)
    with pytest.raises(RuntimeError, match="lost"):
        load.run()
    assert ledger(load) == [] and load.run() == {"LOADED": 1, "rows": 1}
    assert table.refresh().read().count() == 1 and len(ledger(load)) == 1


def test_stage_directory_changes_on_refresh_only(spark, tmp_area, local_dir):
    deliver(local_dir, "a.csv", "1,1")
    deliver(local_dir, "f/b +.csv", "2,2", "3,3")
    d = StageDirectory(spark, local_dir, f"{tmp_area}/d")
    assert d.files().count() == 0 and d.read(SCHEMA).count() == 0
    assert d.refresh() == {"added": 2, "changed": 0, "removed": 0}
    assert sorted((r.name, r.size) for r in d.files().collect()) == [("a.csv", 9), ("f/b +.csv", 13)]
    os.unlink(os.path.join(local_dir, "a.csv"))
    deliver(local_dir, "c.csv", "4,4")
    deliver(local_dir, "f/b +.csv", "2,2", "3,3", "5,5")
    assert sorted(r.name for r in d.files().collect()) == ["a.csv", "f/b +.csv"]      # as of the refresh
    version = d.state.current_version()
    assert d.refresh() == {"added": 1, "changed": 1, "removed": 1}
    assert sorted(r.id for r in d.read(SCHEMA, computed={"id": F.col("id")}).collect()) == [2, 3, 4, 5]
    assert d.refresh() == {"added": 0, "changed": 0, "removed": 0} and d.state.current_version() == version + 1


def test_refresh_audit_is_kept_and_not_doubled(spark, tmp_area):
    audit = RefreshAudit(spark, f"{tmp_area}/a")
    assert audit.read().count() == 0
    history = [(0, "2030-01-01T00:00:00.000Z", 5, 12), (1, "2030-01-01T00:01:00.000Z", 0, 3), (2, "2030-01-01T00:02:00.000Z", 7, 9)]
    assert audit.record("t", history) == 2 and audit.record("t", history) == 0 and audit.record("u", history[:1]) == 1
    assert [(r.batch_id, r.input_rows) for r in RefreshAudit(spark, f"{tmp_area}/a").read("t").collect()] == [(2, 7), (0, 5)]


def test_dimension_step_without_news_does_nothing(spark, tmp_area):
    staging = ManifestTable(spark, f"{tmp_area}/stg", ["id"])
    staging.publish(spark.createDataFrame([(1, 1), (2, 2)], SCHEMA))
    feed, history = ChangeFeed(staging, f"{tmp_area}/_o", ["id"]), AppendTable(spark, f"{tmp_area}/dwh")
    assert version_dimension(history, feed) == 2 and version_dimension(history, feed) == 0
    staging.merge(spark.createDataFrame([(2, 5), (3, 3)], SCHEMA), ["id"], ["q"])
    assert version_dimension(history, feed) == 2 and version_dimension(history, feed) == 0
    assert sorted((r.id, r.q, r.change_seq) for r in history.read().collect()) == [(1, 1, 1), (2, 2, 1), (2, 5, 2), (3, 3, 2)]


def test_message_log(spark, tmp_area):
    a, b = MessageLog(spark, f"{tmp_area}/m"), MessageLog(spark, f"{tmp_area}/m")
    a.log("one")
    b.log("two", "ERROR")
    a.log("three")
    assert sorted((r.message, r.severity) for r in b.read().collect()) == [("one", "INFO"), ("three", "INFO"), ("two", "ERROR")]


def test_current_versions_are_the_open_intervals(spark):
    rng = random.Random(3)
    dates = [None, "2020-01-01", "2020-01-02", "2021-05-05", "9999-12-31", "9998-01-01"]
    rows = [(rng.choice([1, 2, 3, None, 50 + i % 20]), rng.choice(dates), i, rng.choice(["a", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, d string, seq int, v string").withColumn("d", F.to_date("d"))
    want = current_rows(validity_intervals(df, ["k"], "d", ["seq"]), from_col="d")
    got = current_versions(df, ["k"], "d", ["seq"])
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 5), (3, 16)])
def test_sweep_against_brute_force(spark, seed, parts):
    rng = random.Random(seed)
    files = {f"f{i}": (lo := rng.randrange(40), lo + rng.choice([0, 1, 3, 10])) for i in range(60)}
    got = {r.file_name: (r.depth, r.overlaps) for r in sweep(spark.createDataFrame([(f, *r) for f, r in files.items()], "file_name string, min_key int, max_key int"), parts).collect()}
    for f, (lo, hi) in files.items():
        others = [g for g, (a, b) in files.items() if g != f and a <= hi and b >= lo]
        # files of one start: those before it in name have started
        depth = sum(a <= lo <= b and (a, g) <= (lo, f) for g, (a, b) in files.items())
        assert got[f] == (depth, len(others)), f


def test_recluster_rewrites_the_deepest_files_only(spark, tmp_area):
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=10)
    t.publish(spark.createDataFrame([(i, i) for i in range(0, 400, 2)], SCHEMA))
    t.append(spark.createDataFrame([(i, i) for i in range(301, 341, 2)], SCHEMA))
    before, version = set(t.files()), t.current_version()
    assert t.depths().agg(F.max("depth")).first()[0] == 2
    n = t.recluster(rounds=20)
    after = set(t.files())
    assert t.depths().agg(F.max("depth"), F.avg("depth")).first() == (1, 1.0)
    assert 0 < n < len(before) and len(before & after) >= len(before) - n >= 14
    assert sorted(r.id for r in t.read().collect()) == sorted([*range(0, 400, 2), *range(301, 341, 2)])
    assert t.changes(version, t.current_version(), ["id"]).count() == 0 and t.recluster() == 0


def test_lookup_reads_the_files_of_the_value(spark, tmp_area):
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=10, index=["q"])
    t.publish(spark.createDataFrame([(i, i % 50) for i in range(300)], SCHEMA))
    t.append(spark.createDataFrame([(1000, 7), (1001, None)], SCHEMA))
    t.update_where(F.col("id") == 57, {"q": F.lit(8).cast("long")})
    t.delete_where(F.col("id") == 107)
    got = t.lookup("q", 7)
    assert sorted(r.id for r in got.collect()) == [7, 157, 207, 257, 1000]
    held = {r[0] for r in t.read().where("q = 7").select(data_file()).distinct().collect()}
    assert len(got.inputFiles()) == len(held) == 5 < len(t.files())
    assert t.lookup("q", 99).count() == 0 and t.lookup("q", None).count() == 0

"""Tables as lists of files: what a merge rewrites, odd partition values, failures between steps, two writers, long logs,
change rows against snapshot comparison, and the tables maintained from them."""

import random

import pytest
from pyspark.sql import functions as F

from layerkit.operators.changes import ACTION, IS_UPDATE, ChangeFeed, apply_changes, snapshot_diff
from layerkit.sources import commits
from layerkit.sources.commits import CommitLog, ConcurrentWriteError, create_once
from layerkit.sources.manifest import ManifestTable
from layerkit.sources.partitioned import PartitionedTable
from layerkit.sources.snapshot import AppendTable, SnapshotTable
from layerkit.streaming.incremental import ROW_ID, MaintainedAggregate, MaintainedJoin, change_stream

SCH = "id long, part string, q long"


def frame(spark, rows, schema=SCH):
    return spark.createDataFrame(rows, schema)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def test_merge_leaves_files_without_its_keys(spark, tmp_area):
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=10)
    t.publish(frame(spark, [(i, "x", i) for i in range(200)]))
    before = t.files()
    assert len(before) >= 20
    held = t.touched_files(frame(spark, [(55, "x", 0), (57, "x", 0), (1000, "x", 0)]), ["id"])
    assert t.merge(frame(spark, [(55, "y", -1), (57, "y", -2), (1000, "n", 5)]), ["id"], ["part", "q"]) == {"updated": 2, "inserted": 1}
    after = t.files()
    assert set(before) - set(after) == set(held) and 1 <= len(held) <= 2
    assert rows(t.read()) == sorted([(i, "x", i) for i in range(200) if i not in (55, 57)] + [(55, "y", -1), (57, "y", -2), (1000, "n", 5)], key=str)
    assert rows(t.read(1)) == sorted([(i, "x", i) for i in range(200)], key=str)
    assert t.merge(frame(spark, [(2000, "n", 1)]), ["id"], ["q"]) == {"updated": 0, "inserted": 1}
    assert set(after) <= set(t.files())                      # a new key rewrites nothing


ODD = ["", None, " ", "a/b", "%", "x=y", "__HIVE_DEFAULT_PARTITION__", "007", "é"]


def test_partition_values_do_not_collide(spark, tmp_area):
    t = PartitionedTable(spark, f"{tmp_area}/p", "p", F.col("part"))
    t.merge(frame(spark, [(i, v, i) for i, v in enumerate(ODD)]), ["id", "part"], ["q"])
    t.merge(frame(spark, [(100, "", 1)]), ["id", "part"], ["q"])
    want = [(i, v, i) for i, v in enumerate(ODD)] + [(100, "", 1)]
    assert rows(t.read(), "id", "part", "q") == sorted(want, key=str)
    assert t.merge(frame(spark, [(0, "", 7)]), ["id", "part"], ["q"]) == {"updated": 1, "inserted": 0}
    assert t.update_where(F.col("part") == "a/b", {"part": F.lit("")}) == 1
    got = rows(t.read(), "id", "part", "q")
    assert got == sorted([(i, "" if v == "a/b" else v, 7 if i == 0 else i) for i, v in enumerate(ODD)] + [(100, "", 1)], key=str)
    assert rows(t.read().where("part = p or (part is null and p is null)"), "id", "part", "q") == got


def test_key_that_does_not_fix_the_partition_moves_the_row(spark, tmp_area):
    t = PartitionedTable(spark, f"{tmp_area}/p", "p", F.col("part"))
    t.publish(frame(spark, [(1, "a", 1), (2, "a", 2), (3, "b", 3)]))
    assert t.merge(frame(spark, [(1, "b", 9)]), ["id"], ["part", "q"]) == {"updated": 1, "inserted": 0}
    assert rows(t.read(), "id", "part", "q", "p") == [(1, "b", 9, "b"), (2, "a", 2, "a"), (3, "b", 3, "b")]


STEPS = ["_write_data", "_write_changes", "_write_manifest", "commit", "after"]


@pytest.mark.parametrize("step", STEPS)
def test_failure_between_two_steps(spark, tmp_area, monkeypatch, step):
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=5)
    t.publish(frame(spark, [(i, "x", i) for i in range(20)]))
    owner, name = (CommitLog, "commit") if step in ("commit", "after") else (ManifestTable, step)
    real, state = getattr(owner, name), {"fail": True}

    def failing(self, *a, **k):
        if step in ("after", "_write_data", "_write_changes", "_write_manifest"):
            out = real(self, *a, **k)               # the step is done, what follows is not
        if state.pop("fail", False):
            raise RuntimeError("lost")
        return real(self, *a, **k) if step == "commit" else out
    monkeypatch.setattr(owner, name, failing)
    source = frame(spark, [(3, "y", 1), (50, "n", 2), (None, "z", 3)])
    with pytest.raises(RuntimeError, match="lost"):
        t.merge(source, ["id"], ["part", "q"], batch_key="b1")
    fresh = ManifestTable(spark, f"{tmp_area}/t", ["id"])
    old = sorted([(i, "x", i) for i in range(20)], key=str)
    new = sorted([(i, "x", i) for i in range(20) if i != 3] + [(3, "y", 1), (50, "n", 2), (None, "z", 3)], key=str)
    assert fresh.exists() and rows(fresh.read()) == (new if step == "after" else old)
    fresh.merge(source, ["id"], ["part", "q"], batch_key="b1")           # the replay
    fresh.merge(source, ["id"], ["part", "q"], batch_key="b1")
    assert rows(fresh.read()) == new


def test_two_writers_of_a_manifest_table(spark, tmp_area):
    ManifestTable(spark, f"{tmp_area}/t", ["id"]).publish(frame(spark, [(1, "x", 1), (2, "x", 2)]))
    a, b = (ManifestTable(spark, f"{tmp_area}/t", ["id"]).refresh() for _ in range(2))
    real = CommitLog.commit
    meanwhile = [lambda: b.merge(frame(spark, [(2, "b", 20), (3, "b", 30)]), ["id"], ["part", "q"])]

    def commit(self, entry):
        if self is a.log and meanwhile:
            meanwhile.pop()()                          # the other writer publishes between our work and our commit
        return real(self, entry)
    CommitLog.commit = commit
    try:
        assert a.merge(frame(spark, [(2, "a", 200), (3, "a", 300)]), ["id"], ["q"]) == {"updated": 2, "inserted": 0}
        meanwhile.append(lambda: b.append(frame(spark, [(8, "b", 8)])))
        a.append(frame(spark, [(9, "a", 9)]))
    finally:
        CommitLog.commit = real
    assert rows(a.refresh().read()) == [(1, "x", 1), (2, "b", 200), (3, "b", 300), (8, "b", 8), (9, "a", 9)] == rows(b.refresh().read())


def test_two_writers_of_a_snapshot_table(spark, tmp_area):
    one = lambda v: frame(spark, [(v,)], "v long")
    SnapshotTable(spark, f"{tmp_area}/s").publish(one(0))
    a, b = (SnapshotTable(spark, f"{tmp_area}/s").refresh() for _ in range(2))
    a.append(one(10))
    b.append(one(20))
    assert rows(a.refresh().read()) == rows(b.read()) == [(0,), (10,), (20,)]
    stale = SnapshotTable(spark, f"{tmp_area}/s").refresh()
    a.append(one(30), batch_id=7)
    with pytest.raises(ConcurrentWriteError):
        stale.publish(one(99))
    assert stale.append(one(30), batch_id=7) == 4            # the batch is in the table
    assert rows(stale.read()) == [(0,), (10,), (20,), (30,)]


def test_one_creator_only(spark, tmp_area):
    assert create_once(spark, f"{tmp_area}/c/1", "a") and not create_once(spark, f"{tmp_area}/c/1", "b")


def test_opening_a_long_log_reads_few_files(spark, tmp_area, monkeypatch):
    log = CommitLog(spark, f"{tmp_area}/log", checkpoint=20)
    for k in range(333):
        assert log.commit({"n": k})
    read = []
    real = commits.read_marker
    monkeypatch.setattr(commits, "read_marker", lambda s, p: read.append(p) or real(s, p))
    other = CommitLog(spark, f"{tmp_area}/log", checkpoint=20)
    assert [e["n"] for e in other.entries] == list(range(333))
    assert len(read) <= 21
    assert log.commit({"n": 333}) and not other.commit({"n": -1}) and other.refresh().entries[-1] == {"n": 333}


def test_append_table_keeps_a_column_named_batch_id(spark, tmp_area):
    t = AppendTable(spark, f"{tmp_area}/a")
    with pytest.raises(Exception, match="boom"):
        t.append(frame(spark, [(1, 2)], "batch_id long, v long").withColumn("v", F.raise_error(F.lit("boom")).cast("long")), batch_id=0)
    assert not t.exists()
    t.append(frame(spark, [(5, 2)], "batch_id long, v long"), batch_id=0)
    t.append(frame(spark, [(6, 3)], "batch_id long, v long"), batch_id=1)
    assert t.exists() and rows(t.read()) == [(5, 2), (6, 3)] and rows(t.batch(1)) == [(6, 3)]


# ---- change rows ----------------------------------------------------------------------------------

def random_step(rng, spark, t, ids):
    some = lambda n: [(rng.choice([rng.randrange(30), rng.randrange(60), None] if rng.random() < .1 else [rng.randrange(60)]), rng.choice(["a", "", None]), rng.randrange(5)) for _ in range(n)]
    kind = rng.choice(["merge", "merge", "update", "delete", "append", "keep"])
    if kind in ("merge", "keep"):
        unique = list({r[0]: r for r in some(12) if r[0] is not None}.values()) + [r for r in some(2) if r[0] is None]
        t.merge(frame(spark, unique), ["id"], ["part", "q"], keep=F.col("q") != 2 if kind == "keep" else None)
    elif kind == "update":
        t.update_where(F.col("id") % 7 == rng.randrange(7), {"q": F.lit(rng.randrange(5)).cast("long")})
    elif kind == "delete":
        t.delete_where(F.col("id") % 9 == rng.randrange(9))
    else:
        ids[0] += 3
        t.append(frame(spark, [(ids[0] - k, "new", k) for k in range(3)] + [(None, "n", 1)]))


@pytest.mark.parametrize("seed", [1, 2])
def test_change_rows_equal_the_snapshot_comparison(spark, tmp_area, seed):
    rng, ids = random.Random(seed), [1000]
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=6)
    t.publish(frame(spark, [(i, "x", i % 5) for i in range(0, 60, 2)]))
    for _ in range(5):
        random_step(rng, spark, t, ids)
    for after, upto in ((1, t.current_version()), (2, 5), (0, 3), (4, 4)):
        now = t.read(upto)
        old = t.read(after) if after else now.limit(0)
        got = t.changes(after, upto, ["id"])
        assert rows(got) == rows(snapshot_diff(old, now, ["id"]).select(*got.columns)), (after, upto)
        assert rows(apply_changes(old, got, ["id"])) == rows(now)


def test_change_rows_of_variants(spark, tmp_area):
    doc = lambda data: frame(spark, data, "id long, j string").select("id", F.parse_json("j").alias("v"))
    t = ManifestTable(spark, f"{tmp_area}/v", ["id"])
    t.publish(doc([(1, '{"a":1}'), (2, '[2]'), (3, 'null')]))
    t.merge(doc([(1, '{"a":2}'), (4, '"n"'), (None, '7')]), ["id"], ["v"])
    t.merge(doc([(2, '[2]')]), ["id"], ["v"])
    t.delete_where(F.col("id") == 3)
    text = lambda df: rows(df.select("id", F.to_json("v").alias("v"), *[c for c in (ACTION, IS_UPDATE) if c in df.columns]))
    got = t.changes(1, 4, ["id"])
    assert text(got) == text(snapshot_diff(t.read(1), t.read(), ["id"]))
    assert text(apply_changes(t.read(1), got, ["id"])) == text(t.read())


def test_feed_reads_change_files_only(spark, tmp_area):
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=10)
    t.publish(frame(spark, [(i, "x", i) for i in range(300)]))
    t.merge(frame(spark, [(7, "y", 1)]), ["id"], ["q"])
    changes = t.changes(1, 2, ["id"])
    assert all("/changes/" in f for f in changes.inputFiles()) and changes.count() == 2
    seen = []
    feed = ChangeFeed(t, f"{tmp_area}/_o", ["id"])
    assert feed.consume(lambda c, v: seen.append((v, c.count()))) is None and seen == [(2, 300)]
    assert feed.pending() is None
    t.delete_where(F.col("id") < 3)
    feed.consume(lambda c, v: seen.append((v, c.count())))
    assert seen[-1] == (3, 3)


# ---- maintained tables ------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [4])
def test_maintained_aggregate_equals_the_recomputation(spark, tmp_area, seed):
    rng, ids = random.Random(seed), [1000]
    t = ManifestTable(spark, f"{tmp_area}/t", ["id"], file_rows=6)
    t.publish(frame(spark, [(i, rng.choice(["a", "b", None, ""]), rng.choice([None, 1, 2])) for i in range(40)]))
    sums = MaintainedAggregate(spark, f"{tmp_area}/s", t, ["id"], ["part"], ["q"])
    want = lambda: rows(t.read().groupBy("part").agg(F.sum("q").alias("q")))
    sums.refresh()
    assert rows(sums.read()) == want()
    for k in range(4):
        random_step(rng, spark, t, ids)
        if k % 2:
            continue
        state = {"fail": True}
        real = sums.feed._note

        def note(step, version, real=real, state=state):
            if step == "done" and state.pop("fail", False):
                raise RuntimeError("lost")             # merged, not yet noted: the same changes come again
            real(step, version)
        sums.feed._note = note
        with pytest.raises(RuntimeError, match="lost"):
            sums.refresh()
        t.update_where(F.col("id") == 1, {"q": F.lit(77).cast("long")})
        sums.refresh()
        sums.refresh()
        assert rows(sums.read()) == want()
    t.delete_where(F.col("part") == "a")
    sums.refresh()
    assert rows(sums.read()) == want() and "a" not in {r[0] for r in rows(sums.read())}


def join_parts(spark, area, file_rows=4):
    products = ManifestTable(spark, f"{area}/products", ["pid"])
    partners = ManifestTable(spark, f"{area}/partners", ["cid"])

    def transform(facts, dims):
        return (facts.join(dims["product"], facts.good == dims["product"].name).join(dims["partner"], facts.who == dims["partner"].cname)
                .select("pid", "cid", "q", "good", ROW_ID))
    out = MaintainedJoin(spark, f"{area}/out", transform, {"product": (products, ["pid"], "good", "name"), "partner": (partners, ["cid"], "who", "cname")},
                         ["good"], file_rows=file_rows)
    return products, partners, transform, out


FACTS = "good string, who string, q long"


@pytest.mark.parametrize("seed", [1])
def test_maintained_join_equals_the_full_join(spark, tmp_area, seed):
    rng = random.Random(seed)
    products, partners, transform, out = join_parts(spark, tmp_area)
    products.publish(frame(spark, [(i, f"p{i}") for i in range(20)], "pid long, name string"))
    partners.publish(frame(spark, [(i, f"c{i}") for i in range(6)], "cid long, cname string"))
    path, taken = f"{tmp_area}/facts_in", []
    schema = frame(spark, [], FACTS).schema
    for step in range(4):
        batch = [(rng.choice([f"p{rng.randrange(25)}", None]) if rng.random() < .9 else "zz", f"c{rng.randrange(8)}", rng.randrange(9)) for _ in range(25)]
        taken += batch
        frame(spark, batch, FACTS).coalesce(1).write.mode("append").parquet(path)
        if step:
            k = rng.randrange(20)
            products.merge(frame(spark, [(k, rng.choice([f"p{20 + step}", f"p{k}", "zz"])), (100 + step, f"p{21 + step}")], "pid long, name string"), ["pid"], ["name"])
            if step == 2:
                partners.delete_where(F.col("cid") == 3)
                products.delete_where(F.col("pid") == 5)
            if step == 3:
                partners.merge(frame(spark, [(3, "c7"), (9, "c1")], "cid long, cname string"), ["cid"], ["cname"])
        out.refresh(change_stream(spark, path, schema))
        full = transform(frame(spark, taken, FACTS).withColumn(ROW_ID, F.lit("x")), {"product": products.read(), "partner": partners.read()})
        assert rows(out.read(), "pid", "cid", "q", "good") == rows(full, "pid", "cid", "q", "good"), step


def test_one_changed_product_rewrites_only_its_files(spark, tmp_area):
    products, partners, _, out = join_parts(spark, tmp_area, file_rows=20)
    products.publish(frame(spark, [(i, f"p{i:04d}") for i in range(300)], "pid long, name string"))
    partners.publish(frame(spark, [(1, "c1")], "cid long, cname string"))
    path = f"{tmp_area}/facts_in"
    frame(spark, [(f"p{i % 300:04d}", "c1", i) for i in range(1500)], FACTS).coalesce(1).write.parquet(path)
    schema = frame(spark, [], FACTS).schema
    out.refresh(change_stream(spark, path, schema))
    before = set(out.table.files())
    products.merge(frame(spark, [(1000, "p0123")], "pid long, name string"), ["pid"], ["name"])      # a second product of that name
    products.delete_where(F.col("pid") == 123)
    report = out.refresh(change_stream(spark, path, schema))
    assert report["restated"] == {"deleted": 5, "inserted": 5}
    assert len(before) > 50 and len(before - set(out.table.refresh().files())) <= 2
    assert {r["pid"] for r in out.read().where("good = 'p0123'").collect()} == {1000}


def test_a_kept_batch_that_was_not_shown_is_shown_once(spark, tmp_area, monkeypatch):
    products, partners, transform, out = join_parts(spark, tmp_area)
    products.publish(frame(spark, [(1, "p1")], "pid long, name string"))
    partners.publish(frame(spark, [(1, "c1")], "cid long, cname string"))
    path, schema = f"{tmp_area}/facts_in", frame(spark, [], FACTS).schema
    frame(spark, [("p1", "c1", 1), ("p2", "c1", 2)], FACTS).coalesce(1).write.parquet(path)
    real, state = MaintainedJoin._show_batch, {"fail": True}

    def show(self, *a):
        if state.pop("fail", False):
            raise RuntimeError("lost")
        real(self, *a)
    monkeypatch.setattr(MaintainedJoin, "_show_batch", show)
    with pytest.raises(Exception, match="lost"):
        out.refresh(change_stream(spark, path, schema))
    products.merge(frame(spark, [(2, "p2")], "pid long, name string"), ["pid"], ["name"])
    for _ in range(2):
        out.refresh(change_stream(spark, path, schema))
        assert rows(out.read(), "pid", "q") == [(1, 1), (2, 2)]


def test_shared_value_is_written_by_several_tasks(spark, tmp_area):
    t = PartitionedTable(spark, tmp_area, "state", F.col("status"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.publish(spark.range(4000).select("id", F.lit("O").alias("status")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert t.manifest().count() > 1
    assert {(r["lo"][0], r["hi"][0], r["folder_files"]) for r in t.manifest().collect()} == {("O", "O", t.manifest().count())}
    assert t.read().select("id").distinct().count() == 4000

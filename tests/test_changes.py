import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerkit.operators.changes import apply_changes, has_changes, insert_images, snapshot_diff
from layerkit.operators.history import OPEN_END, current_rows, validity_intervals

D = dt.date
GOODS = "good_id int, title string, family string, price int"


def goods(spark, drop=(), **edits):
    rows = {i: (i, f"good {i}", "tools" if i % 2 else "lamps", 10 * i) for i in range(101, 109)}
    rows |= {int(k[1:]): v for k, v in edits.items()}
    return spark.createDataFrame([rows[k] for k in sorted(rows) if k not in drop], GOODS)


def test_diff_counts_and_insert_images(spark):
    prev = goods(spark)
    curr = goods(spark, drop=[104], _102=(102, "good 102", "garden", 1020), _107=(107, "good 107", "tools", 999), _120=(120, "rope", "tools", 5))
    ch = snapshot_diff(prev, curr, ["good_id"])
    got = sorted((r.good_id, r._action, r._is_update) for r in ch.collect())
    assert got == [(102, "DELETE", True), (102, "INSERT", True), (104, "DELETE", False), (107, "DELETE", True), (107, "INSERT", True),
                   (120, "INSERT", False)]
    assert sorted(r.good_id for r in insert_images(ch).collect()) == [102, 107, 120]
    assert not has_changes(snapshot_diff(prev, prev, ["good_id"]))


def test_diff_apply_round_trip(spark):
    prev = goods(spark)
    curr = goods(spark, drop=[101, 108], _105=(105, "good 105", None, 1))
    back = apply_changes(prev, snapshot_diff(prev, curr, ["good_id"]), ["good_id"])
    assert sorted(map(str, back.collect())) == sorted(map(str, curr.collect()))


def test_repeated_keys_are_refused(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "a"), (1, "c")], "k int, v string")
    for prev, curr in ((once, twice), (twice, once)):
        with pytest.raises(ValueError, match="occurs 2 times"):
            snapshot_diff(prev, curr, ["k"])


def test_null_key_rows_with_variants(spark):
    mk = lambda rows: spark.createDataFrame(rows, "k int, j string").select("k", F.parse_json("j").alias("v"))
    ch = snapshot_diff(mk([(None, '{"a":1}'), (1, "[1]")]), mk([(None, '{"a":2}'), (1, "[1]")]), ["k"])
    assert sorted((r.j, r._action) for r in ch.select(F.to_json("v").alias("j"), "_action").collect()) == [('{"a":1}', "DELETE"), ('{"a":2}', "INSERT")]


def test_null_keys_diffed_as_rows(spark):
    prev = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    curr = spark.createDataFrame([(None, "z"), (1, "b")], "k int, v string")
    got = sorted((r.v, r._action) for r in snapshot_diff(prev, curr, ["k"]).collect())
    assert got == [("a", "DELETE"), ("z", "INSERT")]


def test_validity_intervals_and_ties(spark):
    rows = [(i, D(2030, 1, 1), 0, f"f{i}") for i in range(20)] + [(4, D(2030, 9, 9), 1, "new"), (6, D(2030, 1, 1), 1, "tie"), (None, D(2030, 2, 2), 0, "n")]
    iv = validity_intervals(spark.createDataFrame(rows, "k int, vf date, seq int, f string"), ["k"], "vf", ["seq"])
    four = sorted((r.vf, r.valid_to, r.f) for r in iv.filter("k = 4").collect())
    assert four == [(D(2030, 1, 1), D(2030, 9, 9), "f4"), (D(2030, 9, 9), OPEN_END, "new")]
    assert sorted((r.seq, r.valid_to) for r in iv.filter("k = 6").collect()) == [(0, D(2030, 1, 1)), (1, OPEN_END)]
    cur = current_rows(iv, from_col="vf")
    assert cur.count() == 21 and cur.filter("k = 6").first().f == "tie"      # equal-date tie: zero-length interval


def test_validity_intervals_equal_the_window(spark):
    # one key holds most versions and spans several partitions; NULL keys and dates; keys that differ by 1 near 2^53
    rows = [(0, D(2020, 1, 1) + dt.timedelta(days=i % 400), i) for i in range(3000)]
    rows += [(2 ** 53 + k, D(2021, 1, 1) + dt.timedelta(days=k), 0) for k in range(300)]
    rows += [(None, D(2022, 1, 1), i) for i in range(5)] + [(9, None, 1), (9, None, 2), (9, D(2020, 1, 1), 1)]
    df = spark.createDataFrame(rows, "k bigint, vf date, seq int")
    w = Window.partitionBy("k").orderBy("vf", "seq")
    want = sorted(map(str, df.withColumn("valid_to", F.coalesce(F.lead("vf").over(w), F.lit(OPEN_END))).collect()))
    for n in (1, 4, 16):
        got = validity_intervals(df, ["k"], "vf", ["seq"], num_partitions=n)
        assert sorted(map(str, got.collect())) == want
    assert got.filter(F.col("k") > 2 ** 52).filter(F.col("valid_to") != F.lit(OPEN_END)).count() == 0


def test_diff_apply_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rows = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)),
                           max_size=6)

    @settings(max_examples=8, deadline=None)
    @given(rows, rows)
    def check(p, c):
        mk = lambda d: spark.createDataFrame([(k, v[0], v[1]) for k, v in d.items()], "k int, s string, n int")
        prev, curr = mk(p), mk(c)
        ch = snapshot_diff(prev, curr, ["k"])
        assert sorted(apply_changes(prev, ch, ["k"]).collect()) == sorted(curr.collect())
        n_upd = sum(1 for k in p if k in c and p[k] != c[k])
        assert ch.filter("_is_update").count() == 2 * n_upd
    check()

"""One key holding a large share of the rows: the operators split or pre-combine it."""

import contextlib
import io

from pyspark.sql import functions as F

from layerkit.operators.grouping import bounded_chunks
from layerkit.operators.upsert import latest_per_key


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def hot_rows(spark, n=30000):
    # a third of all rows carry key 0, the rest are spread over 1000 keys
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).alias("k"),
                                 F.col("id").alias("v"), (F.col("id") % 97).alias("w"))


def test_bounded_chunks_split_a_hot_key(spark):
    df = hot_rows(spark)
    ch = bounded_chunks(df, ["k"], max_rows=256)
    sizes = ch.groupBy("k", "chunk").count()
    hot = sizes.filter("k = 0")
    assert hot.count() >= 10000 // 256                        # the hot key is spread over many chunks
    assert sizes.agg(F.max("count")).first()[0] == 256         # and no chunk holds more than the bound
    assert hot.count() == -(-10000 // 256)                     # all but the last one are full
    assert ch.count() == df.count()                            # nothing dropped


def test_bounded_chunks_of_equal_rows(spark):
    rows = spark.createDataFrame([(1, "x")] * 2000 + [(None, "y")] * 700 + [(2, "z")], "k int, v string")
    sizes = {(r["k"], r["chunk"]): r["count"] for r in bounded_chunks(rows, ["k"], max_rows=256).groupBy("k", "chunk").count().collect()}
    assert sizes == {(1, c): min(256, 2000 - 256 * c) for c in range(8)} | {(None, c): min(256, 700 - 256 * c) for c in range(3)} | {(2, 0): 1}


def test_latest_per_key_is_a_partial_aggregate(spark):
    df = hot_rows(spark)
    out = latest_per_key(df, ["k"], ["w", "v"])
    text = plan_text(out)
    assert "partial_max" in text and "Window" not in text    # map-side pre-combination, no per-key sort
    got = {r.k: (r.w, r.v) for r in out.collect()}
    want = {r.k: (r.w, r.v) for r in df.groupBy("k").agg(F.max(F.struct("w", "v")).alias("m"))
            .select("k", "m.w", "m.v").collect()}
    assert got == want and len(got) == 1001


def test_small_keys_are_one_chunk_and_not_numbered(spark):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    ch = bounded_chunks(rows, ["k"], max_rows=256)
    assert "Exchange" not in plan_text(ch) and ch.select("chunk").distinct().collect() == [(0,)]
    dealt = ch.repartition("k", "chunk").groupBy("k", "chunk", "v").agg(F.collect_list("v").alias("vs")).groupBy("k", "chunk").agg(F.count("vs").alias("n"))
    assert plan_text(dealt).count("Exchange") == 1            # dealt once for both groupings
    assert {r["n"] for r in dealt.collect()} == {5}


def test_pairs_are_dealt_into_partitions_of_one_size(spark, monkeypatch):
    from layerkit.plans import q_relational
    monkeypatch.setattr(q_relational, "PAIRS_PER_TASK", 500)
    lines = spark.range(20000).select((F.col("id") % 7).alias("s"), F.col("id").alias("p"))
    dealt = q_relational.dealt_by_pair(lines, ["s", "p"])
    sums = dealt.groupBy("s", "p").agg(F.count(F.lit(1)).alias("n"))
    assert plan_text(sums).count("Exchange") == 1
    assert dealt.rdd.getNumPartitions() == 40 and dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000

"""The layered run keeps little on disk besides the tables it writes: documents and summary are made in slices, staged files and
tables are compressed, scratch tables and shuffle files go when they have been read."""

import glob
import time
from collections import Counter

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from layerkit.operators.semistructured import flatten_partner_orders_typed, partner_document_schema
from layerkit.plans import domain as D
from layerkit.plans import q_streaming as Q
from layerkit.session import child_names, ensure_checkpoint_dir, scratch_area, sparing_disk

from .conftest import SF001


def _scratch(spark):
    return set(child_names(spark, f"{ensure_checkpoint_dir(spark)}/layerkit"))


def _shuffle_files(spark):
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_layered_run_in_slices_leaves_its_tables_only(spark, tmp_area, monkeypatch):
    monkeypatch.setattr(Q, "SLICE_LINES", 1000)
    asked = []
    monkeypatch.setattr(Q, "in_slices", lambda df, key, n, most, f=Q.in_slices: asked.append(f(df, key, n, most)) or asked[-1])
    before = _scratch(spark)
    summary, log = Q.run_layered_flow(spark, SF001, tmp_area)
    assert [len(x) for x in asked] == [Q.DOC_SLICES, Q.SUMMARY_SLICES]
    assert _scratch(spark) - before == {tmp_area.rsplit("/", 1)[1]}               # no chunks, no documents
    staged = [n for n in child_names(spark, f"{tmp_area}/stage") if n.startswith("part-")]
    assert staged and all(n.endswith(".gz") for n in staged)
    assert all(".zstd." in n for n in child_names(spark, f"{tmp_area}/stg/json_orders/batch-0000000000") if n.startswith("part-"))
    assert summary.current_version() == 1                                          # all slices are one version
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "part"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    cols = ["delivery_date", "product_name", "category", "total_quantity"]
    want = con.execute(f"select {', '.join(cols)} from ({E.oracle_sql()['layered_run_end_to_end']})").fetchall()
    assert Counter(map(tuple, summary.read().select(cols).collect())) == Counter(want)
    counts = [r["rows_processed"] for r in log.read().where("task_name = 'ORDERS_SUMMARY_TASK'").collect()]
    assert counts == [len(want)]


def test_documents_of_large_and_small_orders(spark, tmp_area, monkeypatch):
    """Small orders are numbered in place, larger ones spread; an order in both deliveries has documents in each."""
    monkeypatch.setattr(Q, "SLICE_LINES", 100)
    big, twice = 2 * D.DOC_MAX_LINES + 5, 300
    keys = [1] * big + [2] * 3 + [3] * twice + [4] * 2 + [None] * 400 + [9]        # 9 has no order
    li = [(k, i % 5, i, float(i % 50), "1998-02-03" if i % 7 else None) for i, k in enumerate(keys)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, d string").select("*", F.col("d").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_area}/lineitem.parquet")
    orders = [(1, 1, "1999-01-01"), (2, 1, "1997-01-01"), (3, 2, "1997-05-05"), (3, 2, "1999-05-05"), (4, 2, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string").select("*", F.col("d").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{tmp_area}/orders.parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "c_custkey long, c_name string").write.parquet(f"{tmp_area}/customer.parquet")
    spark.createDataFrame([(k, "same") for k in range(5)], "p_partkey long, p_name string").write.parquet(f"{tmp_area}/part.parquet")
    with scratch_area(spark, "docs") as area:
        docs = Q._written_docs(spark, tmp_area, area).persist()
        number = {(r["o_orderkey"], r["first"]): r["count"] for r in docs.groupBy("o_orderkey", "first").count().collect()}
        assert number == {(1, False): 3, (2, True): 1, (3, True): 2, (3, False): 2, (4, None): 1}
        parsed = docs.select(F.from_json("value", partner_document_schema("bigint")).alias("d")).select("d.*")
        got = flatten_partner_orders_typed(parsed).collect()
    want = D.order_lines(spark, tmp_area).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want)) and len(want) == big + 3 + 2 * twice + 2


def test_slices_hold_whole_keys_and_every_row(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    parts = Q.in_slices(rows, "k", 5 * Q.SLICE_LINES, 4)
    assert len(parts) == 4 and len(Q.in_slices(rows, "k", Q.SLICE_LINES, 4)) == 1 == len(Q.in_slices(rows, "k", 0, 4))
    held = [p.collect() for p in parts]
    assert sorted(r["v"] for h in held for r in h) == list(range(1000))
    assert sum(len({r["k"] for r in h}) for h in held) == 38


def test_shuffle_files_go_when_the_statement_ends(spark, tmp_area):
    spark.sparkContext._jvm.System.gc()
    settings = {k: spark.conf.get(k) for k in ("spark.sql.parquet.compression.codec", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    before = _shuffle_files(spark)
    with sparing_disk(spark):
        spark.range(10000).repartition(7, "id").write.parquet(f"{tmp_area}/dealt")
        assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert {k: spark.conf.get(k) for k in settings} == settings
    assert spark.read.parquet(f"{tmp_area}/dealt").count() == 10000

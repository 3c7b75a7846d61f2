import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from layerkit.operators.upsert import DuplicateSourceKeyError, observed_upsert, upsert

D = dt.date
SCHEMA = "customer string, order_date date, delivery_date date, baked_good_type string, quantity bigint, source_file_name string"
KEYS = ["customer", "delivery_date", "baked_good_type"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_matched_keeps_order_date_and_updates_quantity(spark):
    tgt = spark.createDataFrame([("Cafe A", D(2023, 7, 7), D(2023, 7, 10), "Bagel", 6, "f1"),
                                 ("Cafe A", D(2023, 7, 7), D(2023, 7, 10), "Roll", 2, "f1")], SCHEMA)
    src = spark.createDataFrame([("Cafe A", D(2023, 7, 8), D(2023, 7, 10), "Bagel", 9, "f2"),
                                 ("Cafe B", D(2023, 7, 8), D(2023, 7, 11), "Bagel", 4, "f2")], SCHEMA)
    out = upsert(tgt, src, KEYS, ["quantity", "source_file_name"])
    assert rows(out) == [
        ("Cafe A", D(2023, 7, 7), D(2023, 7, 10), "Bagel", 9, "f2"),   # order_date kept
        ("Cafe A", D(2023, 7, 7), D(2023, 7, 10), "Roll", 2, "f1"),
        ("Cafe B", D(2023, 7, 8), D(2023, 7, 11), "Bagel", 4, "f2"),
    ]


def test_observed_counts(spark):
    tgt = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 1, "f")], SCHEMA)
    src = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 5, "g"),
                                 ("B", D(2023, 1, 1), D(2023, 1, 2), "x", 5, "g")], SCHEMA)
    merged, obs = observed_upsert(tgt, src, KEYS, ["quantity"])
    merged.write.format("noop").mode("overwrite").save()
    assert obs.get["updated"] == 1 and obs.get["inserted"] == 1


def test_duplicate_source_keys_raise_or_latest(spark):
    tgt = spark.createDataFrame([], SCHEMA)
    src = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 5), "x", 1, "f1"),
                                 ("A", D(2023, 1, 3), D(2023, 1, 5), "x", 7, "f3"),
                                 ("A", D(2023, 1, 2), D(2023, 1, 5), "x", 4, "f2")], SCHEMA)
    with pytest.raises(DuplicateSourceKeyError):
        upsert(tgt, src, KEYS, ["quantity"])
    out = upsert(tgt, src, KEYS, ["quantity"], on_duplicate="latest", order_cols=["order_date"])
    assert rows(out) == [("A", D(2023, 1, 3), D(2023, 1, 5), "x", 7, "f3")]


def test_null_key_part_never_matches(spark):
    src = spark.createDataFrame([(None, D(2023, 1, 1), D(2023, 1, 2), "x", 1, "f")], SCHEMA)
    t1 = upsert(spark.createDataFrame([], SCHEMA), src, KEYS, ["quantity"])
    t2 = upsert(t1, src, KEYS, ["quantity"])
    assert t1.count() == 1 and t2.count() == 2   # inserted again on every run


def test_branch_expressions(spark):
    tgt = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 1, "f")], SCHEMA)
    src = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 2, "g"),
                                 ("B", D(2023, 1, 1), D(2023, 1, 2), "x", 3, "g")], SCHEMA)
    out = upsert(tgt, src, KEYS, ["quantity", "source_file_name"],
                 update_exprs={"source_file_name": F.lit("updated")}, insert_exprs={"source_file_name": F.lit("inserted")})
    assert {r.customer: r.source_file_name for r in out.collect()} == {"A": "updated", "B": "inserted"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upsert_idempotent(spark, seed):
    rnd = random.Random(seed)
    mk = lambda n: [(rnd.choice("ABC"), D(2023, 1, 1), D(2023, 1, rnd.randint(1, 3)), rnd.choice("xy"),
                     rnd.randint(1, 9), "f") for _ in range(n)]
    tgt = upsert(spark.createDataFrame([], SCHEMA), spark.createDataFrame(mk(12), SCHEMA), KEYS, ["quantity"],
                 on_duplicate="latest", order_cols=["quantity"])
    src = spark.createDataFrame(mk(10), SCHEMA)
    kw = dict(on_duplicate="latest", order_cols=["quantity"])
    once = upsert(tgt, src, KEYS, ["quantity"], **kw)
    twice = upsert(once, src, KEYS, ["quantity"], **kw)
    assert rows(once) == rows(twice)


def test_partitioned_merge_rewrites_only_touched_partitions(spark, tmp_area):
    from layerkit.sources.manifest import data_file
    from layerkit.sources.partitioned import PartitionedTable
    t = PartitionedTable(spark, f"{tmp_area}/t", "month", F.date_format("delivery_date", "yyyy-MM"), file_rows=1)
    first = spark.createDataFrame([("A", D(2023, 7, 1), D(2023, 7, 10), "x", 1, "f1"),
                                   ("B", D(2023, 8, 1), D(2023, 8, 10), "x", 2, "f1")], SCHEMA)
    assert t.merge(first, KEYS, ["quantity"]) == {"updated": 0, "inserted": 2}
    july = lambda: {r[0] for r in t.read().where("month = '2023-07'").select(data_file()).collect()}
    before = july()
    second = spark.createDataFrame([("B", D(2023, 8, 2), D(2023, 8, 10), "x", 5, "f2"),
                                    ("C", D(2023, 8, 2), D(2023, 8, 11), "y", 3, "f2")], SCHEMA)
    assert t.merge(second, KEYS, ["quantity", "source_file_name"]) == {"updated": 1, "inserted": 1}
    assert before == july() and len(before) == 1     # the untouched month kept its file
    got = sorted((r.customer, r.quantity, r.order_date) for r in t.read().collect())
    assert got == [("A", 1, D(2023, 7, 1)), ("B", 5, D(2023, 8, 1)), ("C", 3, D(2023, 8, 2))]


def test_load_with_status_reports_failure_and_success(spark):
    from layerkit.operators.upsert import load_with_status
    tgt = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 1, "f")], SCHEMA)
    good = spark.createDataFrame([("A", D(2023, 1, 1), D(2023, 1, 2), "x", 2, "g"),
                                  ("B", D(2023, 1, 1), D(2023, 1, 2), "x", 3, "g")], SCHEMA)
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    assert load_with_status(sink, tgt, good, KEYS, ["quantity"]) == "Load Complete. 2 rows affected"
    msg = load_with_status(sink, tgt, good.unionByName(good), KEYS, ["quantity"])
    assert msg.startswith("Load failed with error message:")


def test_additive_combine_and_partition_update(spark, tmp_area):
    from layerkit.sources.partitioned import PartitionedTable
    sch = "day date, product_id bigint, total bigint"
    t = PartitionedTable(spark, f"{tmp_area}/s", "m", F.date_format("day", "yyyy-MM"))
    add = {"total": lambda a, b: a + b}
    t.merge(spark.createDataFrame([(D(2023, 1, 1), 1, 5), (D(2023, 2, 1), 1, 7)], sch), ["day", "product_id"],
            ["total"], combine=add)
    t.merge(spark.createDataFrame([(D(2023, 1, 1), 1, 3), (D(2023, 1, 1), 2, 1)], sch), ["day", "product_id"],
            ["total"], combine=add)
    got = sorted((r.day, r.product_id, r.total) for r in t.read().collect())
    assert got == [(D(2023, 1, 1), 1, 8), (D(2023, 1, 1), 2, 1), (D(2023, 2, 1), 1, 7)]
    assert t.update_where(F.col("product_id") == 2, {"total": F.lit(0).cast("bigint")}) == 1
    assert sorted(r.total for r in t.read().collect()) == [0, 7, 8]


def test_partitioned_merge_rerun_is_idempotent(spark, tmp_area):
    from layerkit.sources.partitioned import PartitionedTable
    t = PartitionedTable(spark, f"{tmp_area}/idem", "month", F.date_format("delivery_date", "yyyy-MM"))
    src = spark.createDataFrame([("A", D(2023, 7, 1), D(2023, 7, 10), "x", 1, "f1"),
                                 ("B", D(2023, 8, 1), D(2023, 8, 10), "x", 2, "f1")], SCHEMA)
    t.merge(src, KEYS, ["quantity"])
    upd = spark.createDataFrame([("B", D(2023, 8, 2), D(2023, 8, 10), "x", 7, "f2")], SCHEMA)
    t.merge(upd, KEYS, ["quantity"])
    once = rows(t.read())
    t.merge(upd, KEYS, ["quantity"])             # a retried delivery
    assert rows(t.read()) == once and len(once) == 2

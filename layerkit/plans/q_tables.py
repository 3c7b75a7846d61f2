"""Keyed tables kept as lists of files: merges that rewrite few files, change feeds from written change rows,
joins and aggregates maintained from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.manifest import ManifestTable, data_file
from ..sources.partitioned import PartitionedTable
from ..sources.tables import table
from ..streaming.incremental import MaintainedAggregate
from .q_changes import DIFF_SQL, customer_snapshots
from .registry import query

FILES = 40      # about so many files, so that there is something to leave alone


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _file_rows(df) -> int:
    return max(50, df.count() // FILES)


@query("merge_rewrites_few_files", covers="J8 S15", sql="""
with top as (select max(o_orderkey) as k from orders)
select o_orderkey, o_custkey, case when o_orderkey > 0.99 * k then 'U' else o_orderstatus end as o_orderstatus,
       case when o_orderkey > 0.99 * k then o_totalprice + 1.0 else o_totalprice end as o_totalprice from orders, top
union all
select o_orderkey + k + 1, o_custkey, 'N', o_totalprice from orders, top where o_orderkey > 0.99 * k""")
def merge_rewrites_few_files(spark, sf):
    """One percent of the keys is updated and as many are inserted. Only the files that hold an updated key are rewritten; all
    others are the same files as before."""
    orders = _orders(spark, sf)
    target = ManifestTable(spark, scratch_path(spark, "few_files"), ["o_orderkey"], file_rows=_file_rows(orders))
    target.publish(orders)
    before = set(target.files())
    last = orders.agg(F.max("o_orderkey").alias("k"))
    top = orders.join(F.broadcast(last), F.col("o_orderkey") > F.lit(0.99) * F.col("k"))
    changed = top.select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1.0).alias("o_totalprice"))
    added = top.select((F.col("o_orderkey") + F.col("k") + 1).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"), "o_totalprice")
    held = target.touched_files(changed, ["o_orderkey"])
    target.merge(changed.unionByName(added), ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
    rows = target.read()
    read = {r[0] for r in rows.select(data_file()).distinct().collect()}
    if before - read != set(held) or not before & read:
        raise RuntimeError(f"{len(before - read)} files replaced, {len(held)} held a key, {len(before)} there were")
    return rows


@query("merge_odd_partitions", covers="J8 P15", sql="""
with o as (select o_orderkey, o_custkey, case o_orderstatus when 'P' then null when 'F' then '' else o_orderstatus end as status, o_totalprice from orders)
select o_orderkey, o_custkey, case when o_custkey % 3 = 1 and status is null then '' when o_custkey % 3 = 2 and status = '' then 'a/b=c %' else status end as status,
       case when o_custkey % 5 = 0 then o_totalprice + 1.0 else o_totalprice end as o_totalprice from o""")
def merge_odd_partitions(spark, sf):
    """A table partitioned by a column with NULL, empty and awkward values: rows are merged by a key that does not fix
    the partition, and rows move between such partitions."""
    status = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", status.alias("status"), "o_totalprice")
    target = PartitionedTable(spark, scratch_path(spark, "odd_partitions"), "part", F.col("status"), file_rows=_file_rows(orders))
    target.publish(orders)
    third = F.col("o_custkey") % 3
    target.update_where((third == 2) & (F.col("status") == ""), {"status": F.lit("a/b=c %")})
    moved = orders.where((third == 1) & F.col("status").isNull()).withColumn("status", F.lit(""))
    target.merge(moved, ["o_orderkey"], ["status"])
    dearer = orders.where(F.col("o_custkey") % 5 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
    target.merge(dearer, ["o_orderkey"], ["o_totalprice"])
    return target.read().drop("part")


@query("change_feed_files", covers="T5 T6 P11", sql=DIFF_SQL)
def change_feed_files(spark, sf):
    """The net change over five versions of a table, from the change rows written with them: balances changed twice, a row
    inserted and deleted again and a row changed back leave no trace beyond their net change."""
    prev, curr = customer_snapshots(spark, sf)
    customers = ManifestTable(spark, scratch_path(spark, "change_files"), ["c_custkey"], file_rows=_file_rows(prev))
    start = customers.publish(prev)
    raised = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3)
    customers.update_where(raised | (F.col("c_nationkey") == 5), {"c_acctbal": F.lit(0.0)})
    customers.append(curr.where("c_custkey > 1000000000").unionByName(prev.where("c_nationkey = 11").withColumn("c_custkey", -1 - F.col("c_custkey"))))
    customers.delete_where((F.col("c_nationkey") == 24) | (F.col("c_custkey") < 0))
    customers.merge(curr.where(raised | (F.col("c_nationkey") == 5)), ["c_custkey"], ["c_acctbal"])
    return customers.changes(start, customers.current_version(), ["c_custkey"])


@query("maintained_aggregate", covers="T10 A9", sql="""
with o as (
  select o_custkey, case when o_orderpriority = '5-LOW' then null when o_orderkey % 4 = 1 then cast(floor(o_totalprice) as bigint) + 5 else cast(floor(o_totalprice) as bigint) end as price
  from orders where o_orderstatus <> 'P' and o_custkey % 7 <> 2)
select o_custkey as customer_id, cast(sum(price) as bigint) as price from o group by o_custkey""")
def maintained_aggregate(spark, sf):
    """Sums per customer kept while orders are appended, updated (to a value and to NULL) and deleted; a customer without
    orders disappears, and one whose orders have no price has no sum."""
    area = scratch_path(spark, "maintained_aggregate")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderstatus", "o_orderpriority",
                                               F.floor("o_totalprice").cast("bigint").alias("price"))
    facts = ManifestTable(spark, f"{area}/orders", ["o_orderkey"], file_rows=_file_rows(orders))
    sums = MaintainedAggregate(spark, f"{area}/sums", facts, ["o_orderkey"], ["customer_id"], ["price"])
    here = F.col("customer_id") % 7 != 2
    facts.publish(orders.where(here | (F.col("o_orderstatus") == "P")))
    sums.refresh()
    facts.update_where(F.col("o_orderpriority") == "5-LOW", {"price": F.lit(None).cast("bigint")})
    facts.delete_where(F.col("o_orderstatus") == "P")
    sums.refresh()
    dearer = orders.where(here & (F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") != "5-LOW") & (F.col("o_orderkey") % 4 == 1))
    facts.merge(dearer.withColumn("price", F.col("price") + 5), ["o_orderkey"], ["price"])
    sums.refresh()
    return sums.read()


ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


@query("recluster_after_append", covers="L1", sql=f"select {ORDER_COLS} from orders")
def recluster_after_append(spark, sf):
    """A table clustered by customer gets more orders of some customers; only the files that then overlap are rewritten, until no
    customer range is covered twice."""
    orders = _orders(spark, sf)
    target = ManifestTable(spark, scratch_path(spark, "recluster"), ["o_custkey", "o_orderkey"], file_rows=_file_rows(orders))
    cut = orders.agg(F.percentile_approx("o_custkey", 0.8).alias("cut"))
    late = (F.col("o_custkey") > F.col("cut")) & (F.col("o_orderkey") % 3 == 0)
    marked = orders.join(F.broadcast(cut)).withColumn("late", late).drop("cut")
    target.publish(marked.where("not late").drop("late"))
    target.append(marked.where("late").drop("late"))
    before, was = set(target.files()), target.depths().agg(F.max("depth"), F.avg("depth")).first()
    target.recluster(rounds=40)
    now = target.depths().agg(F.max("depth"), F.avg("depth")).first()
    if not (was[0] > 1 == now[0] and now[1] == 1 and before & set(target.files())):
        raise RuntimeError(f"depth was {was}, is {now}")
    return target.read()


LOOKUP_KEY = 40


@query("indexed_point_lookup", covers="L3", sql=f"select {ORDER_COLS} from orders where o_custkey = {LOOKUP_KEY}")
def indexed_point_lookup(spark, sf):
    """Equality look-up through the value-to-file index, kept up over an append and a merge: only the files that the index names
    are read."""
    orders = _orders(spark, sf)
    target = ManifestTable(spark, scratch_path(spark, "lookup"), ["o_orderkey"], file_rows=_file_rows(orders), index=["o_custkey"])
    target.publish(orders.where("o_orderkey % 3 <> 1").withColumn("o_totalprice", F.lit(0.0)))
    target.append(orders.where("o_orderkey % 3 = 1"))
    target.merge(orders.where(f"o_custkey = {LOOKUP_KEY} or o_orderkey % 3 <> 1"), ["o_orderkey"], ["o_totalprice"])
    rows = target.lookup("o_custkey", LOOKUP_KEY)
    held = target.read().where(F.col("o_custkey") == LOOKUP_KEY).select(data_file()).distinct().count()
    if not held <= len(rows.inputFiles()) < len(target.files()) / 2:
        raise RuntimeError(f"{len(rows.inputFiles())} files read, {held} hold the key, {len(target.files())} there are")
    return rows

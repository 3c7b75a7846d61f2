"""Change capture and history queries: snapshot diff, insert images, validity intervals,
current versions and the join to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.changes import ACTION, IS_UPDATE, ChangeFeed, insert_images, snapshot_diff
from ..operators.history import current_versions, validity_intervals
from ..session import scratch_path
from ..sources.snapshot import AppendTable, SnapshotTable
from ..sources.tables import table
from .registry import query

# Edit applied to the customer snapshot (our fixture rules, all derived from attributes)
CUSTOMER_EDIT_SQL = """
prev as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer),
curr as (
  select c_custkey, c_name, c_nationkey,
         case when c_mktsegment = 'BUILDING' and c_nationkey = 3 then c_acctbal + 100.0 else c_acctbal end as c_acctbal,
         c_mktsegment
  from customer where c_nationkey <> 24
  union all
  select c_custkey + 1000000000, c_name || ' II', c_nationkey, c_acctbal, c_mktsegment from customer where c_nationkey = 7)"""


def customer_snapshots(spark, sf):
    prev = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    bump = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3)
    kept = (prev.filter(F.col("c_nationkey") != 24)
            .withColumn("c_acctbal", F.when(bump, F.col("c_acctbal") + 100.0).otherwise(F.col("c_acctbal"))))
    added = (prev.filter(F.col("c_nationkey") == 7)
             .withColumn("c_custkey", F.col("c_custkey") + 1000000000)
             .withColumn("c_name", F.concat(F.col("c_name"), F.lit(" II"))))
    return prev, kept.unionByName(added)


DIFF_SQL = f"""with {CUSTOMER_EDIT_SQL},
j as (select p.c_custkey as pk, p.c_name as pn, p.c_nationkey as pnat, p.c_acctbal as pbal, p.c_mktsegment as pseg,
             c.*, (p.c_custkey is not null and c.c_custkey is not null and
                   (p.c_name is distinct from c.c_name or p.c_nationkey is distinct from c.c_nationkey or
                    p.c_acctbal is distinct from c.c_acctbal or p.c_mktsegment is distinct from c.c_mktsegment)) as changed
      from prev p full outer join curr c on p.c_custkey = c.c_custkey)
select pk as c_custkey, pn as c_name, pnat as c_nationkey, pbal as c_acctbal, pseg as c_mktsegment,
       'DELETE' as {ACTION}, changed as {IS_UPDATE}
from j where pk is not null and (c_custkey is null or changed)
union all
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'INSERT', changed
from j where c_custkey is not null and (pk is null or changed)"""


@query("cdc_snapshot_diff", covers="T5 P11", sql=DIFF_SQL)
def cdc_snapshot_diff(spark, sf):
    prev, curr = customer_snapshots(spark, sf)
    return snapshot_diff(prev, curr, ["c_custkey"])


@query("cdc_insert_images", covers="T6 P11", sql=f"""with d as ({DIFF_SQL})
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from d where {ACTION} = 'INSERT'""")
def cdc_insert_images(spark, sf):
    prev, curr = customer_snapshots(spark, sf)
    return insert_images(snapshot_diff(prev, curr, ["c_custkey"]))


@query("change_feed_offset", covers="T4 T5 T7", sql=f"""
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'INSERT' as {ACTION}, false as {IS_UPDATE}, 1 as table_version
from customer
union all
select *, 2 from ({DIFF_SQL})""")
def change_feed_offset(spark, sf):
    """Change stream on an updated table, read from the consumer's stored offset: the first load, a run
    without news (the gate: nothing is applied), then the edited version."""
    area = scratch_path(spark, "change_feed")
    customers, seen = SnapshotTable(spark, f"{area}/customer_tbl"), AppendTable(spark, f"{area}/changes_tbl")
    feed = ChangeFeed(customers, f"{area}/_offset", ["c_custkey"])
    apply = lambda changes, version: seen.append(changes.withColumn("table_version", F.lit(version)), batch_id=version)
    prev, curr = customer_snapshots(spark, sf)
    customers.publish(prev)
    feed.consume(apply)
    feed.consume(apply)
    customers.publish(curr)
    feed.consume(apply)
    return seen.read()


def order_versions(spark, sf):
    """Each order is a new version of its customer's record, valid from the order date;
    equal dates are ordered by the order key (the change sequence)."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("version_seq"),
                    F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("valid_from"))


SCD2_SQL = """
select o_custkey as customer_id, o_orderkey as version_seq, o_orderstatus as status,
       cast(o_orderdate as date) as valid_from,
       coalesce(lead(cast(o_orderdate as date)) over (partition by o_custkey order by o_orderdate, o_orderkey),
                date '9999-12-31') as valid_to
from orders"""


@query("scd2_intervals", covers="W1 W2 F4", sql=SCD2_SQL)
def scd2_intervals(spark, sf):
    return validity_intervals(order_versions(spark, sf), ["customer_id"], "valid_from", ["version_seq"])


@query("scd2_current", covers="W3", sql=f"""with h as ({SCD2_SQL})
select * from h where valid_to = date '9999-12-31' and valid_from < valid_to""")
def scd2_current(spark, sf):
    return current_versions(order_versions(spark, sf), ["customer_id"], "valid_from", ["version_seq"])


# Product history: an initial copy of ``part`` valid from a fixed date, then a re-categorisation
# of the large sizes (fixture rule) valid from a later date.
INITIAL_FROM, CHANGE_FROM = "1995-01-01", "1998-01-01"


def product_history(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                                        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"), "p_size")
    edited = p.withColumn("category", F.when(F.col("p_size") >= 45, F.concat(F.lit("PROMO "), F.col("category")))
                          .otherwise(F.col("category")))
    new_versions = insert_images(snapshot_diff(p.drop("p_size"), edited.drop("p_size"), ["product_id"]))
    version = lambda df, since, seq: df.withColumn("valid_from", F.lit(since).cast("date")).withColumn("seq", F.lit(seq))
    return version(p.drop("p_size"), INITIAL_FROM, 1).unionByName(version(new_versions, CHANGE_FROM, 2))


@query("current_version_join", covers="J5 W3 A8 T6", sql=f"""
with cur as (select p_partkey as product_id, p_name as product_name,
                    case when p_size >= 45 then 'PROMO ' || p_type else p_type end as category from part)
select cast(l.l_shipdate as date) as delivery_date, cur.product_name, cur.category,
       cast(sum(cast(l.l_quantity as bigint)) as bigint) as total_quantity
from lineitem l left join cur on l.l_partkey = cur.product_id
group by all""")
def current_version_join(spark, sf):
    cur = current_versions(product_history(spark, sf), ["product_id"], "valid_from", ["seq"]).select("product_id", "product_name", "category")
    li = table(spark, sf, "lineitem")
    return (li.join(cur, li.l_partkey == cur.product_id, "left")
            .groupBy(F.to_date("l_shipdate").alias("delivery_date"), "product_name", "category")
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity")))

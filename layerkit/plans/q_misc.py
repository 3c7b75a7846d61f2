"""Reports over the event log, access policies, physical layout, geo CTAS, refresh history."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.geo import METRES_PER_KM, haversine_m, parse_wkt_point
from ..operators.layout import cluster_by, depth_histogram, layout_report, write_with_bloom
from ..operators.policy import apply_mask, apply_row_policy, protected_view
from ..operators.reporting import MessageLog, daily_report, newest_first, topk_recent
from ..operators.reuse import reused
from ..session import scratch_path, shuffle_partitions
from ..sources.snapshot import SnapshotTable
from ..sources.tables import table
from ..streaming.incremental import change_stream, consume
from . import domain as D
from .q_relational import FILTERED_SUM_SQL, PART_ID, filtered_sum_of
from .registry import query

AS_OF = _dt.date(2024, 1, 31)   # "now" of the log reports (the event log ends 2024-01-30)
TOPK, TOPK_DAYS, REPORT_DAYS = 50, 3, 10


@query("topk_recent", covers="P10 O5 L7 F1 F2 F3", sql=f"""
select event_id, event_type, value, ts from events
where cast(ts as date) > date '{AS_OF}' - interval {TOPK_DAYS} day
order by value desc, event_id limit {TOPK}""")
def topk_recent_q(spark, sf):
    ev = table(spark, sf, "events")
    return topk_recent(ev, "ts", "value", TOPK, AS_OF, TOPK_DAYS, ["event_id"]).select("event_id", "event_type", "value", "ts")


@query("daily_load_report", covers="A7 L8 O3 F2 F3", sql=f"""
select cast(ts as date) as day, event_type,
       cast(sum(cast(value as decimal(18,2))) as decimal(18,2)) as total_value,
       cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total_k
from events where cast(ts as date) > date '{AS_OF}' - interval {REPORT_DAYS} day
group by 1, 2 order by 1, 2""")
def daily_load_report(spark, sf):
    ev = table(spark, sf, "events")
    return daily_report(ev, "ts", "event_type", {
        "total_value": F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)"),
        "total_k": F.sum(F.get_json_object("props", "$.k").cast("bigint")),
    }, AS_OF, REPORT_DAYS)


@query("event_log_recent", covers="L6 O1", sql="""
select event_id, ts, event_type as severity, props as message from events order by ts desc, event_id""")
def event_log_recent(spark, sf):
    """Messages appended to the log table (errors by one writer, all others by a second), listed newest first."""
    log = MessageLog(spark, f"{scratch_path(spark, 'message_log')}/log")
    messages = table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("severity"), F.col("props").alias("message"))
    log.append(messages.filter(F.col("severity") == "error"))
    MessageLog(spark, log.rows.root).append(messages.filter(F.col("severity") != "error"))
    return newest_first(log.read(), "ts", "event_id").select("event_id", "ts", "severity", "message")


@query("result_reuse", covers="L9 A2", sql=f"""with s as ({FILTERED_SUM_SQL}) select a.*, b.n from s a, (select count(*) as n from s) b""")
def result_reuse(spark, sf):
    """A result used twice with reuse switched on: the second use reads the kept result, which is released at the end."""
    result = filtered_sum_of(table(spark, sf, "lineitem"))
    with reused(result) as kept:
        n = kept.count()
        if not kept.storageLevel.useMemory:
            raise RuntimeError("the result is not kept")
        path = scratch_path(spark, "result_reuse")
        kept.withColumn("n", F.lit(n).cast("bigint")).write.parquet(path)
    if result.storageLevel.useMemory:
        raise RuntimeError("the result was not released")
    return spark.read.parquet(path)


# Role rules of the department policy (fixture: market segments play the departments)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ROW_RULES = {"ENGINEER": None, **{f"ANALYST_{s}": [s] for s in SEGMENTS}}
ADDRESS_ROLES = {"ENGINEER"}
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("row_policy", covers="G1 P9 P14 F14", sql="""
select c_custkey, c_name, c_nationkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')""")
def row_policy(spark, sf):
    c = table(spark, sf, "customer").select(*CUST_COLS)
    return apply_row_policy(c, "c_mktsegment", ROW_RULES, {"ANALYST_BUILDING", "ANALYST_MACHINERY", "PUBLIC"})


@query("mask_policy", covers="G2 P14", sql="""
select c_custkey, '***' as c_name, c_nationkey, c_mktsegment from customer""")
def mask_policy(spark, sf):
    c = table(spark, sf, "customer").select(*CUST_COLS)
    return apply_mask(c, "c_name", ADDRESS_ROLES, {"ANALYST_HOUSEHOLD"})


@query("protected_view", covers="G3 G1 G2", sql="""
select c_custkey, '***' as c_name, c_mktsegment from customer where c_mktsegment = 'HOUSEHOLD'""")
def protected_view_q(spark, sf):
    c = table(spark, sf, "customer").select(*CUST_COLS)
    return protected_view(c, {"ANALYST_HOUSEHOLD"}, row_rules=("c_mktsegment", ROW_RULES),
                          masks={"c_name": ADDRESS_ROLES}, columns=["c_custkey", "c_name", "c_mktsegment"])


@query("protected_view_engineer", covers="G3 G1 G2", sql="""
select c_custkey, c_name, c_mktsegment from customer""")
def protected_view_engineer(spark, sf):
    c = table(spark, sf, "customer").select(*CUST_COLS)
    return protected_view(c, {"ENGINEER"}, row_rules=("c_mktsegment", ROW_RULES),
                          masks={"c_name": ADDRESS_ROLES}, columns=["c_custkey", "c_name", "c_mktsegment"])


@query("clustered_filter", covers="L1 A2 P5", sql=FILTERED_SUM_SQL)
def clustered_filter(spark, sf):
    """The filtered sum over a copy of the sales table clustered by store id: files hold
    narrow store ranges, so the equality filter skips most files/row groups."""
    path = scratch_path(spark, "clustered_lineitem")
    cluster_by(table(spark, sf, "lineitem"), path, ["l_suppkey"])
    return filtered_sum_of(spark.read.parquet(path))


@query("bloom_point_lookup", covers="L3", sql=f"""
select l_suppkey as store_id, cast(sum(cast(l_quantity as bigint)) as bigint) as total_quantity
from lineitem where l_partkey = {PART_ID} group by l_suppkey""")
def bloom_point_lookup(spark, sf):
    path = scratch_path(spark, "bloom_lineitem")
    write_with_bloom(table(spark, sf, "lineitem"), path, ["l_partkey"])
    li = spark.read.parquet(path)
    return (li.filter(F.col("l_partkey") == PART_ID).groupBy(F.col("l_suppkey").alias("store_id"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity")))


LAYOUT_FILES_SQL = """
r as (select case when o_orderkey % 50 = 0 then o_orderkey // 400 + 3 else o_orderkey // 400 end as g, min(o_orderkey) as lo, max(o_orderkey) as hi from orders group by 1),
f as (select a.g, any_value(a.lo) as lo, any_value(a.hi) as hi, count(*) - 1 as others, count(*) filter (where b.lo <= a.lo and (b.lo < a.lo or b.g <= a.g)) as depth
      from r a join r b on b.lo <= a.hi and b.hi >= a.lo group by a.g)"""


def _overlapping_files(spark, sf):
    """Orders in files whose key ranges are known: one file per 400 keys, with every fiftieth key three files on. A task writes
    the files of a range of groups and moves them into place itself (committer version 2), so neither one task nor the driver
    handles every file."""
    path = scratch_path(spark, "layout_orders")
    key = F.col("o_orderkey")
    group = F.floor(key / 400) + F.when(key % 50 == 0, 3).otherwise(0)
    (table(spark, sf, "orders").select("o_orderkey", group.alias("g")).repartitionByRange(shuffle_partitions(spark), "g")
     .write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("g").parquet(path))
    return path


@query("layout_report", covers="L2", sql=f"""with {LAYOUT_FILES_SQL}
select count(*) as total_files, count(*) filter (where lo = hi) as constant_files, avg(others) as average_overlaps, avg(depth) as average_depth,
       max(depth) as max_depth from f""")
def layout_report_q(spark, sf):
    return layout_report(spark, _overlapping_files(spark, sf), "o_orderkey")


@query("layout_depths", covers="L2", sql=f"with {LAYOUT_FILES_SQL} select depth, count(*) as files from f group by depth")
def layout_depths(spark, sf):
    """Histogram of the clustering depth."""
    return depth_histogram(spark, _overlapping_files(spark, sf), "o_orderkey")


@query("geo_enriched_ctas", covers="S20 P2 F6 F7", sql=f"""
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       round({D.haversine_sql(D.CUSTOMER_LON_SQL, D.CUSTOMER_LAT_SQL)} / 1000, 2) as distance_km
from customer""")
def geo_enriched_ctas(spark, sf):
    """``create table ... as select *, distance`` written as a table and read back."""
    g = D.customer_geo(spark, sf)
    lon, lat = parse_wkt_point(F.col("store_loc_wkt"))
    enriched = g.select("*", F.round(haversine_m(lon, lat, D.ORIGIN_LON, D.ORIGIN_LAT) / METRES_PER_KM, 2)
                        .alias("distance_km")).drop("store_loc_wkt")
    snap = SnapshotTable(spark, scratch_path(spark, "geo_ctas"))
    snap.publish(enriched)
    return snap.read()


@query("refresh_history", covers="T11 A9", sql="""
select 'user_event_counts' as table_name, 0 as batch_id, count(*) as input_rows from events where event_type = 'click'
union all select 'user_event_counts', 1, count(*) from events where event_type <> 'click'""")
def refresh_history(spark, sf):
    """Refresh history of a dynamic table (event counts per user, maintained additively as new events arrive in two deliveries), from
    the audit table that the refreshes append to: one row per refresh, newest first. A refresh without news adds none."""
    from ..sources.snapshot import AppendTable
    from ..streaming.incremental import RefreshAudit, incremental_aggregate
    area = scratch_path(spark, "refresh_history")
    ev = table(spark, sf, "events")
    src = AppendTable(spark, f"{area}/events")
    counts = SnapshotTable(spark, f"{area}/user_event_counts")
    audit = RefreshAudit(spark, f"{area}/refresh_audit")
    delta = lambda df: df.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    for b, part in enumerate([ev.filter(F.col("event_type") == "click"), ev.filter(F.col("event_type") != "click"), None]):
        if part is not None:
            src.append(part.coalesce(1), batch_id=b)
        incremental_aggregate(change_stream(spark, src.root, ev.schema), delta, ["user_id"], ["events"], counts, f"{area}/_ckpt", audit=(audit, "user_event_counts"))
    return RefreshAudit(spark, f"{area}/refresh_audit").read("user_event_counts").select("table_name", "batch_id", "input_rows")


@query("layout_file_totals", covers="L1 L2", sql="""
select count(*) as total_rows, min(l_suppkey) as min_key, max(l_suppkey) as max_key from lineitem""")
def layout_file_totals(spark, sf):
    """The per-file key ranges of the clustered copy account for every row and the whole key range."""
    from ..operators.layout import file_key_ranges
    path = scratch_path(spark, "layout_totals")
    cluster_by(table(spark, sf, "lineitem"), path, ["l_suppkey"])
    r = file_key_ranges(spark, path, "l_suppkey")
    return r.agg(F.sum("rows").cast("bigint").alias("total_rows"), F.min("min_key").alias("min_key"),
                 F.max("max_key").alias("max_key"))


@query("refresh_history_totals", covers="T11", sql="select count(*) as input_rows from events")
def refresh_history_totals(spark, sf):
    """Input rows over all refreshes of a dynamic table equal the rows appended to its source."""
    h = refresh_history(spark, sf)
    return h.agg(F.sum("input_rows").cast("bigint").alias("input_rows"))

"""Relational queries: scans, filters, joins, semi-joins, aggregates, unions, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import date_dimension_for
from ..functions.geo import METRES_PER_KM, METRES_PER_MILE, haversine_m, parse_wkt_point
from ..session import scratch_path, shuffle_partitions
from ..sources.tables import table
from . import domain as D
from .registry import query
from .sqlrules import holiday_sql

# Parameters of the listed queries (our choices for the shared tables)
STORE_ID = 42             # equality filter of the filtered sums
PART_ID = 42              # equality lookup of the point-lookup query
MIN_PRODUCTS = 518        # "stores selling more than n distinct products" (median at sf0.01)
MAX_DISTANCE_KM = 1000    # inner distance filter of the filtered semi-join


@query("base_scan", covers="S23 P1 P4", sql="""
select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status,
       o_totalprice as total_price, cast(o_orderdate as date) as order_date, o_orderpriority as priority
from orders""")
def base_scan(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_price"),
                    F.to_date("o_orderdate").alias("order_date"), F.col("o_orderpriority").alias("priority"))


@query("union_sources", covers="U1 S24", sql="""
select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as bigint) as quantity, 'feed_a' as source
from lineitem where l_returnflag = 'A'
union all
select l_orderkey, l_partkey, cast(l_quantity as bigint), 'feed_n' from lineitem where l_returnflag = 'N'
union all
select l_orderkey, l_partkey, cast(l_quantity as bigint), 'feed_r' from lineitem where l_returnflag = 'R'""")
def union_sources(spark, sf):
    li = table(spark, sf, "lineitem")
    feeds = []
    for flag in ("A", "N", "R"):
        feeds.append(li.filter(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"), F.lit(f"feed_{flag.lower()}").alias("source")))
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out


@query("labelled_counts", covers="U2 A6 P12 P5", sql=f"""
select 'Total rows' as filtering_type, count(*) as row_count from lineitem
union all
select 'Filtered rows' as filtering_type, count(*) as row_count from lineitem where l_suppkey = {STORE_ID}""")
def labelled_counts(spark, sf):
    li = table(spark, sf, "lineitem")
    total = li.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("Total rows").alias("filtering_type"), "row_count")
    filt = (li.filter(F.col("l_suppkey") == STORE_ID).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit("Filtered rows").alias("filtering_type"), "row_count"))
    return total.unionByName(filt)


FILTERED_SUM_SQL = f"""
select l_partkey as product_id, cast(sum(cast(l_quantity as bigint)) as bigint) as total_quantity
from lineitem where l_suppkey = {STORE_ID} group by l_partkey"""


def filtered_sum_of(li):
    return (li.filter(F.col("l_suppkey") == STORE_ID)
            .groupBy(F.col("l_partkey").alias("product_id"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity")))


@query("filtered_sum", covers="A2 P5 P6", sql=FILTERED_SUM_SQL)
def filtered_sum(spark, sf):
    return filtered_sum_of(table(spark, sf, "lineitem"))


def store_table(spark, sf):
    """Store dimension with its distance as a stored column (created once, as a table): a
    predicate on the distance then stays a column filter on the small dimension instead of
    the point/distance expression being re-derived on every sales row."""
    path = scratch_path(spark, "stores")
    D.supplier_geo(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _sales(spark, sf):
    li = dealt_by_pair(table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_quantity"), ["l_suppkey", "l_partkey"])
    return li.join(store_table(spark, sf), li.l_suppkey == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("store_id"), "distance_km", F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("sales_quantity"))


PAIRS_PER_TASK = 1_000_000


def dealt_by_pair(lines, keys):
    """The lines dealt by ``keys`` into as many partitions as keep a task to about ``PAIRS_PER_TASK`` lines: the hash table of
    an aggregation by them then has one size, whatever the table and the session's number of partitions."""
    return lines.repartition(max(shuffle_partitions(lines.sparkSession), -(-lines.count() // PAIRS_PER_TASK)), *keys)


def _semi_join_having(sales, inner_filter=None):
    """``select store, distance, product, sum(q) ... where store in (stores with > n distinct
    products) group by store, distance, product``.

    The filter is on a grouping key, so the sums are computed first (partial aggregation on
    the map side, shuffle on all three keys: a store holding a large share of the sales is
    spread over its products). The distinct-product count per store is taken from the
    aggregated rows (one per store x distance x product, far fewer than the sales), and the
    store list - one row per store - filters the sums through a semi-join. The aggregated
    rows are one subtree used twice, so their exchange is reused.
    """
    sums = (sales.groupBy("store_id", "distance_km", "product_id")
            .agg(F.sum("sales_quantity").alias("total_quantity")))
    inner = sums if inner_filter is None else sums.filter(inner_filter)
    stores = (inner.groupBy("store_id").agg(F.countDistinct("product_id").alias("product_cnt"))
              .filter(F.col("product_cnt") > MIN_PRODUCTS).select("store_id"))
    return sums.join(stores, "store_id", "left_semi").orderBy("distance_km")


_SALES_SQL = f"""with geo as ({D.SUPPLIER_GEO_SQL}),
sales as (select l_suppkey as store_id, distance_km, l_partkey as product_id, cast(l_quantity as bigint) as sales_quantity
          from lineitem join geo on l_suppkey = s_suppkey)"""


@query("semi_join_having", covers="J6 A3 A4 A5 O2", sql=_SALES_SQL + f"""
select store_id, distance_km, product_id, cast(sum(sales_quantity) as bigint) as total_quantity
from sales
where store_id in (select store_id from (select store_id, count(distinct product_id) as product_cnt
                   from sales group by store_id having count(distinct product_id) > {MIN_PRODUCTS}))
group by store_id, distance_km, product_id order by distance_km""")
def semi_join_having(spark, sf):
    return _semi_join_having(_sales(spark, sf))


@query("semi_join_having_filtered", covers="P7 D14 J6 A3", sql=_SALES_SQL + f"""
select store_id, distance_km, product_id, cast(sum(sales_quantity) as bigint) as total_quantity
from sales
where store_id in (select store_id from (select store_id, count(distinct product_id) as product_cnt
                   from sales where distance_km < {MAX_DISTANCE_KM}
                   group by store_id having count(distinct product_id) > {MIN_PRODUCTS}))
group by store_id, distance_km, product_id order by distance_km""")
def semi_join_having_filtered(spark, sf):
    # the distance filter sits only in the inner query; outer rows stay unfiltered (as written)
    return _semi_join_having(_sales(spark, sf), F.col("distance_km") < MAX_DISTANCE_KM)


def product_dim(spark, sf):
    """Product dimension: every row of ``part``; names repeat there, so the natural key is name and key."""
    p = table(spark, sf, "part")
    return p.select(F.concat("p_name", F.lit(" #"), "p_partkey").alias("product_name"), F.col("p_partkey").alias("product_id"))


def partner_dim(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("partner_id"), F.col("c_name").alias("partner_name"))


def normalize_orders(stg, partners, products, keep=()):
    """Staged order lines (names) -> warehouse order rows (surrogate keys): two inner equi-joins. ``keep``: columns of
    the lines that go along."""
    return (stg.join(partners, stg.customer == partners.partner_name)
            .join(products, stg.baked_good_type == products.product_name)
            .select("partner_id", "product_id", "delivery_date", "order_date", "quantity", *keep))


STAR_SQL = f"""with ord as ({D.ORDER_LINES_SQL}),
prd as (select p_name || ' #' || p_partkey as product_name, p_partkey as product_id from part)
select pt.c_custkey as partner_id, prd.product_id, ord.delivery_date, ord.order_date, ord.quantity
from ord join customer pt on pt.c_name = ord.customer
join prd on prd.product_name = ord.baked_good_type"""


@query("star_inner_join", covers="J1 J2", sql=STAR_SQL)
def star_inner_join(spark, sf):
    return normalize_orders(D.order_lines(spark, sf), partner_dim(spark, sf), product_dim(spark, sf))


@query("orders_by_category", covers="J4 A8", sql="""
select cast(l.l_shipdate as date) as delivery_date, p.p_name as product_name, p.p_type as category,
       cast(sum(cast(l.l_quantity as bigint)) as bigint) as total_quantity
from lineitem l left join part p on l.l_partkey = p.p_partkey
group by all""")
def orders_by_category(spark, sf):
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
            .groupBy(F.to_date("l_shipdate").alias("delivery_date"), F.col("p_name").alias("product_name"),
                     F.col("p_type").alias("category"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity")))


@query("holiday_left_join", covers="J3 F11 F12 F13", sql=f"""
with span as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders),
cal as (select cast(d as date) as day from span, range(lo, hi + interval 1 day, interval 1 day) t(d)),
dim as (select day, {holiday_sql('day')} as holiday_flg from cal)
select o.o_orderkey as order_id, cast(o.o_orderdate as date) as order_date, dim.holiday_flg
from orders o left join dim on cast(o.o_orderdate as date) = dim.day""")
def holiday_left_join(spark, sf):
    o = table(spark, sf, "orders")
    dim = date_dimension_for(o, "o_orderdate")
    od = o.select(F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"))
    return od.join(dim, od.order_date == dim.day, "left").select("order_id", "order_date", "holiday_flg")


@query("date_dimension", covers="F11 F12 F13 S21", sql=f"""
with span as (select least(min(cast(o_orderdate as date)), (select min(cast(l_shipdate as date)) from lineitem)) as lo,
                     greatest(max(cast(o_orderdate as date)), (select max(cast(l_shipdate as date)) from lineitem)) as hi
              from orders),
cal as (select cast(d as date) as day from span, range(lo, hi + interval 1 day, interval 1 day) t(d))
select day, {holiday_sql('day')} as holiday_flg from cal""")
def date_dimension_q(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderdate").alias("d"))
    li = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d"))
    return date_dimension_for(o.unionByName(li), "d")


def _geo_cols(df):
    lon, lat = parse_wkt_point(F.col("store_loc_wkt"))
    dist = haversine_m(lon, lat, D.ORIGIN_LON, D.ORIGIN_LAT)
    return lon, lat, dist


_CUST_DIST = f"{D.haversine_sql(D.CUSTOMER_LON_SQL, D.CUSTOMER_LAT_SQL)}"


@query("geo_distance", covers="F6 F7 F8 P3", sql=f"""
select c_custkey as store_id, c_nationkey as postal_code, c_mktsegment as region,
       round({_CUST_DIST} / 1609, 2) as distance_miles, round({_CUST_DIST} / 1000, 2) as distance_km
from customer""")
def geo_distance(spark, sf):
    g = D.customer_geo(spark, sf)
    _, _, dist = _geo_cols(g)
    return g.select(F.col("c_custkey").alias("store_id"), F.col("c_nationkey").alias("postal_code"),
                    F.col("c_mktsegment").alias("region"),
                    F.round(dist / METRES_PER_MILE, 2).alias("distance_miles"),
                    F.round(dist / METRES_PER_KM, 2).alias("distance_km"))


@query("distinct_topk", covers="P13 O5 O6", sql=f"""
select distinct c_nationkey as postal_code, c_mktsegment as region, round({_CUST_DIST} / 1000, 2) as distance_km
from customer order by distance_km, postal_code, region limit 10""")
def distinct_topk(spark, sf):
    g = D.customer_geo(spark, sf)
    _, _, dist = _geo_cols(g)
    return (g.select(F.col("c_nationkey").alias("postal_code"), F.col("c_mktsegment").alias("region"),
                     F.round(dist / METRES_PER_KM, 2).alias("distance_km"))
            .distinct().orderBy("distance_km", "postal_code", "region").limit(10))

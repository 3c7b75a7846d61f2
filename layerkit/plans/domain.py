"""Mapping of the bakery pipeline domain onto the shared test tables, and fixture staging.

order line = lineitem ⋈ orders ⋈ customer ⋈ part:
  customer = c_name, order_date = o_orderdate, delivery_date = l_shipdate,
  baked_good_type = p_name and key (names repeat), quantity = l_quantity (whole numbers)
partner = customer (partner_id = c_custkey), product = part (product_id = p_partkey),
store = supplier (store_id = s_suppkey), sales = lineitem, log feed = events,
reviews / e-mails = documents.

Everything here is derived from the given tables with Spark; staged files are written by
Spark into a fresh folder below the shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grouping import bounded_chunks, chunks_in_place
from ..operators.semistructured import (K_CUSTOMER, K_DELIVERY_DATE, K_GOOD, K_ITEM, K_ITEMS, K_ORDER_DATE,
                                        K_ORDER_DATETIME, K_ORDER_ID, K_ORDERS, K_ORDERS_BY_DAY, K_QUANTITY)
from ..sources.tables import table

# Origin point of the distance calculations (fixed values: longitude, latitude)
ORIGIN_LON, ORIGIN_LAT = -84.19, 39.76
# Split date between the first and the second delivery of staged files (our fixture choice)
BATCH_SPLIT = "1998-01-01"
DOC_MAX_LINES = 256


def order_lines(spark: SparkSession, sf: str, with_ids: bool = False, lineitem: DataFrame | None = None) -> DataFrame:
    """``lineitem``: rows of that table (by default all)."""
    li = (table(spark, sf, "lineitem") if lineitem is None else lineitem).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    # the names are joined to the narrow sides first, so a line moves twice: by its part, then by its order
    named_orders = o.join(c, o.o_custkey == c.c_custkey)
    j = (li.join(p, li.l_partkey == p.p_partkey)
         .join(named_orders, li.l_orderkey == o.o_orderkey))
    cols = [F.col("c_name").alias("customer"), F.to_date("o_orderdate").alias("order_date"),
            F.to_date("l_shipdate").alias("delivery_date"), F.concat("p_name", F.lit(" #"), "p_partkey").alias("baked_good_type"),
            F.col("l_quantity").cast("bigint").alias("quantity")]
    if with_ids:
        cols += [F.col("o_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("c_custkey")]
    return j.select(*cols)


ORDER_LINES_SQL = """
select c.c_name as customer, cast(o.o_orderdate as date) as order_date,
       cast(l.l_shipdate as date) as delivery_date, p.p_name || ' #' || p.p_partkey as baked_good_type,
       cast(l.l_quantity as bigint) as quantity
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join part p on l.l_partkey = p.p_partkey"""


def partner_order_docs(lines: DataFrame, by: tuple[str, ...] = (), area: str | None = None, in_place: bool = False) -> DataFrame:
    """One JSON document (text column ``value``) per order and bounded chunk:
    {Customer, Order date, Orders: [{Delivery date, Orders by day: [{Baked good type, Quantity}]}]}
    ``by``: more columns that part documents; they go along. ``area``: see :func:`bounded_chunks`. ``in_place``: no order
    is too large for a task."""
    keys = ["o_orderkey", *by]
    rows = lines.select(*keys, "customer", "order_date", "delivery_date", "baked_good_type", "quantity")
    if in_place:
        ch = chunks_in_place(rows, keys, DOC_MAX_LINES)
    else:
        ch = bounded_chunks(rows, keys, DOC_MAX_LINES, area=area).repartition(*keys, "chunk")    # once for both groupings
    day = (ch.groupBy(*keys, "chunk", "customer", "order_date", "delivery_date")
           .agg(F.collect_list(F.struct(F.col("baked_good_type").alias(K_GOOD),
                                        F.col("quantity").alias(K_QUANTITY))).alias(K_ORDERS_BY_DAY)))
    doc = (day.groupBy(*keys, "chunk", "customer", "order_date")
           .agg(F.collect_list(F.struct(F.col("delivery_date").alias(K_DELIVERY_DATE),
                                        F.col(K_ORDERS_BY_DAY))).alias(K_ORDERS)))
    return doc.select(*keys, F.to_json(F.struct(F.col("customer").alias(K_CUSTOMER),
                                                       F.col("order_date").alias(K_ORDER_DATE),
                                                       F.col(K_ORDERS))).alias("value"))


def service_order_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery-service documents: {Order id, Order datetime, Items: [{Item, Quantity}]} per order chunk."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    rows = (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
            .select("o_orderkey", "o_orderdate", "l_linenumber", "p_name",
                    F.col("l_quantity").cast("int").alias("qty")))
    ch = bounded_chunks(rows, ["o_orderkey"], DOC_MAX_LINES)
    doc = (ch.groupBy("o_orderkey", "chunk", "o_orderdate")
           .agg(F.collect_list(F.struct(F.col("p_name").alias(K_ITEM), F.col("qty").alias(K_QUANTITY))).alias(K_ITEMS)))
    return doc.select("o_orderkey", "o_orderdate", F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias(K_ORDER_ID),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias(K_ORDER_DATETIME),
        F.col(K_ITEMS))).alias("value"))


def supplier_geo(spark: SparkSession, sf: str) -> DataFrame:
    """Stores: a point derived from the supplier key, and its rounded distance to the origin."""
    from ..functions.geo import METRES_PER_KM, haversine_m, parse_wkt_point, wkt_point
    s = table(spark, sf, "supplier").select("s_suppkey")
    s = s.select("s_suppkey",
                 wkt_point(F.lit(ORIGIN_LON) + ((F.col("s_suppkey") * 7) % 200 - 100) / 10.0,
                           F.lit(ORIGIN_LAT) + ((F.col("s_suppkey") * 13) % 160 - 80) / 10.0).alias("store_loc_wkt"))
    lon, lat = parse_wkt_point(F.col("store_loc_wkt"))
    return s.select("s_suppkey", F.round(haversine_m(lon, lat, ORIGIN_LON, ORIGIN_LAT) / METRES_PER_KM, 2)
                    .alias("distance_km"))


def haversine_sql(lon: str, lat: str) -> str:
    """The same distance in DuckDB SQL (metres)."""
    from ..functions.geo import EARTH_RADIUS_M
    return (f"(2 * {EARTH_RADIUS_M} * asin(sqrt(pow(sin((radians({ORIGIN_LAT}) - radians({lat})) / 2), 2) + "
            f"cos(radians({lat})) * cos(radians({ORIGIN_LAT})) * pow(sin((radians({ORIGIN_LON}) - radians({lon})) / 2), 2))))")


SUPPLIER_GEO_SQL = f"""
select s_suppkey, round({haversine_sql('(-84.19 + ((s_suppkey * 7) % 200 - 100) / 10.0)',
                                       '(39.76 + ((s_suppkey * 13) % 160 - 80) / 10.0)')} / 1000, 2) as distance_km
from supplier"""


def customer_geo(spark: SparkSession, sf: str) -> DataFrame:
    """Retail points: customers with a point derived from the key (longitude first in the WKT)."""
    from ..functions.geo import wkt_point
    c = table(spark, sf, "customer")
    return c.select("*",
                    wkt_point(F.lit(ORIGIN_LON) + ((F.col("c_custkey") * 7) % 200 - 100) / 10.0,
                              F.lit(ORIGIN_LAT) + ((F.col("c_custkey") * 13) % 160 - 80) / 10.0).alias("store_loc_wkt"))


CUSTOMER_LON_SQL = "(-84.19 + ((c_custkey * 7) % 200 - 100) / 10.0)"
CUSTOMER_LAT_SQL = "(39.76 + ((c_custkey * 13) % 160 - 80) / 10.0)"

"""Semi-structured operators: variant path access, lateral flattening, text tables, payloads.

All flattening is a ``Generate`` (``inline``) in the same stage as the scan: map-only, no
shuffle. Variant paths are cast to declared types with ``variant_get`` (a wrong-case or
missing key yields NULL, like the quoted-key access it replaces).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key names inside the partner order documents (fixed values: they must match the files)
K_CUSTOMER = "Customer"
K_ORDER_DATE = "Order date"
K_ORDERS = "Orders"
K_DELIVERY_DATE = "Delivery date"
K_ORDERS_BY_DAY = "Orders by day"
K_GOOD = "Baked good type"
K_QUANTITY = "Quantity"
# Key names inside the delivery-service documents (fixed values)
K_ORDER_ID = "Order id"
K_ORDER_DATETIME = "Order datetime"
K_ITEMS = "Items"
K_ITEM = "Item"


def vpath(key: str) -> str:
    """JSON path for one quoted key (keys contain blanks)."""
    return '$["' + key.replace('"', '\\"') + '"]'


def vget(col: str | Column, key: str, dtype: str) -> Column:
    """Value of a key cast to a type: a missing key gives NULL, a value that cannot be cast fails the query."""
    return F.variant_get(F.col(col) if isinstance(col, str) else col, vpath(key), dtype)


def partner_orders_type(quantity_type: str = "decimal(38,0)") -> str:
    return ("array<struct<`%s`: date, `%s`: array<struct<`%s`: string, `%s`: %s>>>>"
            % (K_DELIVERY_DATE, K_ORDERS_BY_DAY, K_GOOD, K_QUANTITY, quantity_type))


def flatten_partner_orders(raw: DataFrame, variant_col: str = "customer_orders",
                           quantity_type: str = "decimal(38,0)",
                           keep: tuple[str, ...] = ("source_file_name", "load_ts")) -> DataFrame:
    """Two dependent lateral flattens: document -> deliveries -> order lines (inner: empty arrays vanish)."""
    keep = [c for c in keep if c in raw.columns]
    lvl1 = raw.select(
        vget(variant_col, K_CUSTOMER, "string").alias("customer"),
        vget(variant_col, K_ORDER_DATE, "date").alias("order_date"),
        F.inline(vget(variant_col, K_ORDERS, partner_orders_type(quantity_type))),
        *keep)
    lvl2 = lvl1.select("customer", "order_date", F.col(K_DELIVERY_DATE).alias("delivery_date"),
                       F.inline(F.col(K_ORDERS_BY_DAY)), *keep)
    return lvl2.select("customer", "order_date", "delivery_date",
                       F.col(K_GOOD).alias("baked_good_type"), F.col(K_QUANTITY).alias("quantity"), *keep)


def partner_document_schema(quantity_type: str = "decimal(38,0)") -> T.StructType:
    """Declared shape of a partner order document (typed read: nested columns can be pruned)."""
    return T.StructType.fromDDL("`%s` string, `%s` date, `%s` %s"
                                % (K_CUSTOMER, K_ORDER_DATE, K_ORDERS, partner_orders_type(quantity_type)))


def flatten_partner_orders_typed(docs: DataFrame, keep: tuple[str, ...] = ("source_file_name", "load_ts")) -> DataFrame:
    """The same two-level flatten over documents read with the declared schema (no variant)."""
    keep = [c for c in keep if c in docs.columns]
    lvl1 = docs.select(F.col(K_CUSTOMER).alias("customer"), F.col(K_ORDER_DATE).alias("order_date"),
                       F.inline(F.col(K_ORDERS)), *keep)
    lvl2 = lvl1.select("customer", "order_date", F.col(K_DELIVERY_DATE).alias("delivery_date"),
                       F.inline(F.col(K_ORDERS_BY_DAY)), *keep)
    return lvl2.select("customer", "order_date", "delivery_date",
                       F.col(K_GOOD).alias("baked_good_type"), F.col(K_QUANTITY).alias("quantity"), *keep)


def service_items_type(quantity_type: str = "int") -> str:
    return "array<struct<`%s`: string, `%s`: %s>>" % (K_ITEM, K_QUANTITY, quantity_type)


def keyed_document_columns(raw: DataFrame, variant_col: str = "v") -> DataFrame:
    """Keyed scan of delivery-service documents: id, time, and the item list kept unflattened."""
    rest = [c for c in raw.columns if c != variant_col]
    return raw.select(
        vget(variant_col, K_ORDER_ID, "string").alias("order_id"),
        vget(variant_col, K_ORDER_DATETIME, "timestamp_ntz").alias("order_datetime"),
        F.variant_get(F.col(variant_col), vpath(K_ITEMS), "variant").alias("items"),
        *rest)


def flatten_items(keyed: DataFrame, quantity_type: str = "int") -> DataFrame:
    """Single lateral flatten of the item array (rows with an empty or missing array vanish)."""
    rest = [c for c in keyed.columns if c != "items"]
    return keyed.select(*rest, F.inline(F.variant_get("items", "$", service_items_type(quantity_type)))) \
        .select(*rest, F.col(K_ITEM).alias("baked_good_type"), F.col(K_QUANTITY).alias("quantity"))


def csv_text_to_rows(df: DataFrame, text_col: str, schema: T.StructType, *, has_header: bool = True,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """A text table (lines separated by newlines, fields by commas) to typed rows.

    Lines are exploded with their position so the header (line 0) can be dropped; every
    field is trimmed before the cast (the lines may be indented).
    """
    lines = df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("__ln", "__line"))
    if has_header:
        lines = lines.filter(F.col("__ln") > 0)
    lines = lines.filter(F.length(F.trim(F.col("__line"))) > 0)
    as_text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = lines.select(*keep, F.from_csv(F.col("__line"), as_text).alias("__r"))
    cols = [F.trim(F.col("__r")[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return parsed.select(*keep, *cols)


# Review payload shapes (fixed values: response field names of the review service)
SEARCH_PAYLOAD = "struct<businesses: array<struct<id: string, name: string>>>"
REVIEWS_PAYLOAD = "struct<reviews: array<struct<user: struct<name: string>, text: string, rating: int>>>"


def review_payload_rows(df: DataFrame, search_col: str = "search_json", reviews_col: str = "reviews_json") -> DataFrame:
    """Search response -> first business; reviews response -> one row per review."""
    s = F.from_json(F.col(search_col), SEARCH_PAYLOAD)
    r = F.from_json(F.col(reviews_col), REVIEWS_PAYLOAD)
    b = df.select(s["businesses"].getItem(0).alias("b"), r["reviews"].alias("reviews"))
    return b.select(F.col("b.id").alias("business_id"), F.col("b.name").alias("business_name"),
                    F.inline("reviews")) \
        .select("business_id", "business_name", F.col("user.name").alias("user_name"),
                F.col("text").alias("review_text"), "rating")

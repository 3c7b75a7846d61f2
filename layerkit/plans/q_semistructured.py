"""Semi-structured queries: nested JSON documents as variant, keyed items, text tables,
review payloads, prompt text and sentiment tags."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ORDER_PROMPT_TEMPLATE, prompt_build, sentiment_tag
from ..operators.grouping import bounded_chunks
from ..operators.semistructured import (K_CUSTOMER, K_ORDER_DATE, csv_text_to_rows, flatten_items,
                                        flatten_partner_orders, flatten_partner_orders_typed, keyed_document_columns,
                                        partner_document_schema, review_payload_rows, vget)
from ..session import scratch_path
from ..sources.snapshot import AppendTable
from ..sources.stage import FileFormat, read_stage
from ..sources.tables import table
from . import domain as D
from .registry import query


def land_json(docs, path, **options):
    """Write documents (JSON text column ``value``) as JSON-lines files. ``options``: of the text writer."""
    docs.select("value").write.mode("append").options(**options).text(path)


@query("json_variant_flatten", covers="S11 N1 N3 J7 P4", sql=D.ORDER_LINES_SQL)
def json_variant_flatten(spark, sf):
    area = scratch_path(spark, "json_variant_flatten")
    land_json(D.partner_order_docs(D.order_lines(spark, sf, with_ids=True)), f"{area}/stage")
    raw = read_stage(spark, f"{area}/stage", None, FileFormat.json(), variant_col="customer_orders")
    return flatten_partner_orders(raw, quantity_type="bigint").drop("source_file_name", "load_ts")


@query("json_typed_flatten", covers="S11 N3 J7 P4", sql=D.ORDER_LINES_SQL)
def json_typed_flatten(spark, sf):
    """The same documents read with their declared nested schema instead of a variant."""
    area = scratch_path(spark, "json_typed_flatten")
    land_json(D.partner_order_docs(D.order_lines(spark, sf, with_ids=True)), f"{area}/stage")
    docs = read_stage(spark, f"{area}/stage", partner_document_schema("bigint"), FileFormat.json(), with_file=False)
    return flatten_partner_orders_typed(docs)


SERVICE_ITEMS_SQL = """
select cast(o.o_orderkey as varchar) as order_id, o.o_orderdate as order_datetime,
       p.p_name as baked_good_type, cast(l.l_quantity as integer) as quantity
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey"""


@query("keyed_json_items", covers="S12 N2 N4", sql=SERVICE_ITEMS_SQL)
def keyed_json_items(spark, sf):
    area = scratch_path(spark, "keyed_json_items")
    land_json(D.service_order_docs(spark, sf), f"{area}/stage")
    raw = read_stage(spark, f"{area}/stage", None, FileFormat.json(), variant_col="v", with_file=False)
    return flatten_items(keyed_document_columns(raw, "v"))


@query("null_probe", covers="P8 D15", sql="""
select distinct c.c_name as customer, cast(o.o_orderdate as date) as order_date
from orders o join customer c on o.o_custkey = c.c_custkey
where o.o_orderstatus = 'F' and exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)""")
def null_probe(spark, sf):
    """Documents of another shape share the folder: their keyed scan has no order time."""
    area = scratch_path(spark, "null_probe")
    land_json(D.service_order_docs(spark, sf), f"{area}/stage")
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    foreign = D.order_lines(spark, sf, with_ids=True).join(o, "o_orderkey", "left_semi")
    land_json(D.partner_order_docs(foreign), f"{area}/stage")
    raw = read_stage(spark, f"{area}/stage", None, FileFormat.json(), variant_col="v", with_file=False)
    probe = raw.select("v", vget("v", "Order datetime", "timestamp_ntz").alias("order_datetime"))
    return (probe.filter(F.col("order_datetime").isNull())
            .select(vget("v", K_CUSTOMER, "string").alias("customer"), vget("v", K_ORDER_DATE, "date").alias("order_date"))
            .distinct())


EMAIL_ORDER_SCHEMA = T.StructType([
    T.StructField("customer", T.StringType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("delivery_date", T.DateType(), False),
    T.StructField("item", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
])
# Header line of the extracted order text (fixed value)
EMAIL_ORDER_HEADER = "CUSTOMER,ORDER_DATE,DELIVERY_DATE,ITEM,QUANTITY"


@query("csv_text_to_rows", covers="F10 X3", sql="""
select c.c_name as customer, cast(o.o_orderdate as date) as order_date, cast(l.l_shipdate as date) as delivery_date,
       p.p_name || ' #' || p.p_partkey as item, cast(l.l_quantity as integer) as quantity
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey join part p on l.l_partkey = p.p_partkey""")
def csv_text_to_rows_q(spark, sf):
    """Completion texts (a header and indented CSV lines per order) parsed back to typed rows."""
    lines = D.order_lines(spark, sf, with_ids=True)
    ch = bounded_chunks(lines, ["o_orderkey"], D.DOC_MAX_LINES)
    line = F.concat_ws(",", "customer", F.col("order_date").cast("string"), F.col("delivery_date").cast("string"),
                       "baked_good_type", F.col("quantity").cast("string"))
    texts = (ch.groupBy("o_orderkey", "chunk")
             .agg(F.concat(F.lit(EMAIL_ORDER_HEADER + "\n"),
                           F.array_join(F.transform(F.collect_list(line), lambda x: F.concat(F.lit("  "), x)), "\n"))
                  .alias("completion")))
    # the procedure appends the extracted rows to the collected-orders table and returns them
    collected = AppendTable(spark, scratch_path(spark, "collected_orders_from_email"))
    collected.append(csv_text_to_rows(texts, "completion", EMAIL_ORDER_SCHEMA), batch_id=0)
    return collected.read()


REVIEWS_PER_PAYLOAD = 8


@query("review_payload_rows", covers="S25 S17", sql=f"""
select 'biz-' || (doc_id // {REVIEWS_PER_PAYLOAD}) as business_id, 'Business ' || (doc_id // {REVIEWS_PER_PAYLOAD}) as business_name,
       lang as user_name, text as review_text, cast(n_chars % 5 + 1 as integer) as rating
from documents""")
def review_payload_rows_q(spark, sf):
    """Search and review responses (JSON text) -> first business x each review."""
    d = table(spark, sf, "documents")
    biz = F.floor(F.col("doc_id") / REVIEWS_PER_PAYLOAD).cast("bigint")
    payloads = (d.groupBy(biz.alias("b"))
                .agg(F.collect_list(F.struct(F.struct(F.col("lang").alias("name")).alias("user"),
                                             F.col("text").alias("text"),
                                             (F.col("n_chars") % 5 + 1).cast("int").alias("rating"))).alias("reviews"))
                .select(F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("biz-"), F.col("b").cast("string")).alias("id"),
                                                            F.concat(F.lit("Business "), F.col("b").cast("string")).alias("name")))
                                           .alias("businesses"))).alias("search_json"),
                        F.to_json(F.struct("reviews")).alias("reviews_json")))
    return review_payload_rows(payloads)


def _sql_text(s: str) -> str:
    return "(" + " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in s.split("\n")) + ")"


@query("prompt_build", covers="X4", sql=f"select doc_id, {_sql_text(ORDER_PROMPT_TEMPLATE)} || text as prompt from documents")
def prompt_build_q(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", prompt_build("text").alias("prompt"))


def _sentiment_sql(neg, pos):
    n = " or ".join(f"contains(lower(text), '{w}')" for w in neg)
    p = " or ".join(f"contains(lower(text), '{w}')" for w in pos)
    return (f"select doc_id, case when text is null then null when {n} then 'negative' "
            f"when {p} then 'positive' else 'neutral' end as sentiment from documents")


@query("sentiment_tag", covers="X1 X2 F9", sql=_sentiment_sql(("bad", "terrible"), ("great", "excellent")))
def sentiment_tag_q(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", sentiment_tag("text").alias("sentiment"))


# other keyword lists, so that all three outcomes occur on the generated texts
ALT_NEGATIVE, ALT_POSITIVE = ("thin",), ("her",)


@query("sentiment_tag_words", covers="X1 X2 F9", sql=_sentiment_sql(ALT_NEGATIVE, ALT_POSITIVE))
def sentiment_tag_words(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", sentiment_tag("text", ALT_NEGATIVE, ALT_POSITIVE).alias("sentiment"))

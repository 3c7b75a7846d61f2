"""Streaming and incrementally maintained tables: file ingest, change streams over the raw
table, dynamic flatten / join / aggregate, and the chained pipeline with its run log."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import ChangeFeed, insert_images
from ..operators.history import current_versions
from ..operators.reporting import RunLog, run_summary_message
from ..operators.semistructured import flatten_items, flatten_partner_orders, keyed_document_columns
from ..session import scratch_area, scratch_path, sparing_disk
from ..sources.manifest import ManifestTable
from ..sources.partitioned import PartitionedTable
from ..sources.snapshot import AppendTable, SnapshotTable
from ..sources.stage import FileFormat, land
from ..sources.tables import table
from ..streaming.incremental import ROW_ID, MaintainedJoin, change_stream, consume, incremental_aggregate, incremental_map
from ..streaming.ingest import FileIngest, stream_stage
from . import domain as D
from .q_changes import CHANGE_FROM, INITIAL_FROM, product_history
from .q_relational import STAR_SQL, normalize_orders, partner_dim, product_dim
from .q_semistructured import SERVICE_ITEMS_SQL, land_json
from .registry import query

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
EVENT_SPLIT = "2024-01-15"


@query("stream_file_ingest", covers="T1 T2 S4", sql="select event_id, ts, user_id, event_type, value, props from events")
def stream_file_ingest(spark, sf):
    """Continuous ingest (pipe): event files arrive in two deliveries; the file stream with its
    checkpoint appends each file once (availableNow = run until caught up, then stop)."""
    area = scratch_path(spark, "stream_file_ingest")
    ev = table(spark, sf, "events")
    ingest = FileIngest(spark, f"{area}/stage", f"{area}/events_raw", f"{area}/_ckpt", FileFormat.json(), EVENT_SCHEMA)
    land(ev.filter(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")), ingest.stage_path, FileFormat.json())
    ingest.run()
    land(ev.filter(F.col("ts") >= F.lit(EVENT_SPLIT).cast("timestamp_ntz")), ingest.stage_path, FileFormat.json())
    ingest.run()
    return ingest.read().select(*EVENT_SCHEMA.names)


RAW_SCHEMA = T.StructType([T.StructField("customer_orders", T.VariantType()),
                           T.StructField("source_file_name", T.StringType()),
                           T.StructField("load_ts", T.TimestampType())])


SLICE_LINES = 2_000_000
DOC_SLICES, SUMMARY_SLICES = 3, 6   # at most
FILE_DOCS = 100_000                 # documents of a staged file at most: a compressed file is read by one task


def in_slices(df, key, n: int, most: int) -> list:
    """Parts of ``df`` that hold all rows of a ``key`` each, for work on ``n`` rows by that key: one after the other they
    shuffle a share of the rows at a time, so fewer bytes wait on disk. Each reads ``df`` again, so there are ``most`` of them."""
    slices = max(1, min(most, -(-n // SLICE_LINES)))
    return [df] if slices == 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(slices)) == i) for i in range(slices)]


def _written_docs(spark, sf, area):
    """The documents of both deliveries, made in one pass; ``first`` tells the delivery. Orders of one document are
    gathered where the join has put them, larger ones by :func:`bounded_chunks`."""
    lineitem, path = table(spark, sf, "lineitem"), f"{area}/docs"
    large = (lineitem.where("l_orderkey is not null").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > D.DOC_MAX_LINES).select("l_orderkey"))
    large.write.parquet(f"{area}/large_orders")
    large = spark.read.schema(large.schema).parquet(f"{area}/large_orders")
    kinds = [(lineitem, True)] if large.isEmpty() else [(lineitem.join(large, "l_orderkey", "left_anti"), True), (lineitem.join(large, "l_orderkey", "left_semi"), False)]
    n = lineitem.count()
    for rows, in_place in kinds:
        lines = D.order_lines(spark, sf, with_ids=True, lineitem=rows).withColumn("first", F.col("order_date") < F.lit(D.BATCH_SPLIT).cast("date"))
        for part in in_slices(lines, "o_orderkey", n, DOC_SLICES):
            with scratch_area(spark, "chunks") as chunks:
                docs = D.partner_order_docs(part, by=("first",), area=chunks, in_place=in_place)
                docs.write.mode("append").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def layered_flatten(spark, sf, area, log: RunLog | None = None):
    """EXT -> STG: copy JSON documents into the raw table; a change stream on the raw table feeds the
    flatten (gated: a run without new rows does nothing). Returns the staging append table."""
    copy = FileIngest(spark, f"{area}/stage", f"{area}/ext/json_orders", f"{area}/_ckpt/copy",
                      FileFormat.json(), variant_col="customer_orders")
    stg = AppendTable(spark, f"{area}/stg/json_orders")
    with sparing_disk(spark), scratch_area(spark, "docs") as made:
        docs = _written_docs(spark, sf, made)
        for part in (docs.filter("first"), docs.filter("not first")):
            land_json(part, f"{area}/stage", compression="gzip", maxRecordsPerFile=FILE_DOCS)
            n = copy.run()
            if log:
                log.log_step("COPY_ORDERS_TASK", n)
            rep = incremental_map(change_stream(spark, copy.target_path, RAW_SCHEMA),
                                  lambda df: flatten_partner_orders(df, quantity_type="bigint"),
                                  stg, f"{area}/_ckpt/flatten")
            if log:
                log.log_step("INSERT_ORDERS_STG_TASK", rep["appended"])
    return stg


@query("incremental_flatten", covers="T3 T4 T7 N3", sql=D.ORDER_LINES_SQL)
def incremental_flatten(spark, sf):
    stg = layered_flatten(spark, sf, scratch_path(spark, "incremental_flatten"))
    return stg.read().select("customer", "order_date", "delivery_date", "baked_good_type", "quantity")


@query("dynamic_flatten", covers="T8 N2", sql=SERVICE_ITEMS_SQL)
def dynamic_flatten(spark, sf):
    """Dynamic table over a flatten: one streaming query, stage -> keyed scan -> inline -> Parquet sink."""
    area = scratch_path(spark, "dynamic_flatten")
    docs = D.service_order_docs(spark, sf)
    land_json(docs.filter(F.col("o_orderdate") < F.lit(D.BATCH_SPLIT).cast("timestamp_ntz")), f"{area}/stage")

    def run():
        s = stream_stage(spark, f"{area}/stage", None, FileFormat.json(), variant_col="v", with_file=False)
        q = (flatten_items(keyed_document_columns(s, "v")).writeStream.format("parquet")
             .option("checkpointLocation", f"{area}/_ckpt").trigger(availableNow=True).start(f"{area}/orders_flat"))
        q.awaitTermination()

    run()
    land_json(docs.filter(F.col("o_orderdate") >= F.lit(D.BATCH_SPLIT).cast("timestamp_ntz")), f"{area}/stage")
    run()
    return spark.read.parquet(f"{area}/orders_flat")


LINE_TABLE_SCHEMA = T.StructType([
    T.StructField("customer", T.StringType()), T.StructField("order_date", T.DateType()),
    T.StructField("delivery_date", T.DateType()), T.StructField("baked_good_type", T.StringType()),
    T.StructField("quantity", T.LongType())])


def _staged_lines_in_two_batches(spark, sf, path):
    lines = D.order_lines(spark, sf)
    split = F.lit(D.BATCH_SPLIT).cast("date")
    return (lambda: lines.filter(F.col("order_date") < split).write.mode("append").parquet(path),
            lambda: lines.filter(F.col("order_date") >= split).write.mode("append").parquet(path))


@query("dynamic_join", covers="T9 J9 J2", sql=STAR_SQL)
def dynamic_join(spark, sf):
    """Dynamic table over the star join. The products of large sizes are renamed between the deliveries: what they
    concern of the first batch is joined again, the rest stays."""
    area = scratch_path(spark, "dynamic_join")
    stg_path = f"{area}/stg_lines"
    partners = ManifestTable(spark, f"{area}/partner_tbl", ["partner_id"])
    products = ManifestTable(spark, f"{area}/product_tbl", ["product_id"])
    cluster = ["baked_good_type"]
    target = MaintainedJoin(spark, f"{area}/orders_tbl",
                            lambda df, dims: normalize_orders(df, dims["partner"], dims["product"], keep=[*cluster, ROW_ID]),
                            {"partner": (partners, ["partner_id"], "customer", "partner_name"),
                             "product": (products, ["product_id"], "baked_good_type", "product_name")}, cluster)
    renamed = table(spark, sf, "part").filter("p_size >= 45").select(F.col("p_partkey").alias("product_id"))
    current = product_dim(spark, sf)
    large = current.join(renamed, "product_id", "left_semi").select(*current.columns)
    earlier = large.withColumn("product_name", F.concat(F.lit("draft "), "product_name"))
    partners.publish(partner_dim(spark, sf))
    products.publish(current.join(renamed, "product_id", "left_anti").select(*current.columns).unionByName(earlier))
    first, second = _staged_lines_in_two_batches(spark, sf, stg_path)
    first()
    target.refresh(change_stream(spark, stg_path, LINE_TABLE_SCHEMA))
    products.merge(large, ["product_id"], ["product_name"])
    second()
    target.refresh(change_stream(spark, stg_path, LINE_TABLE_SCHEMA))
    return target.read().drop(*cluster)


def summary_view(summary, products):
    """Summary at fact grain joined with the current product versions (names, categories)."""
    return (summary.join(products, "product_id", "left")
            .groupBy("delivery_date", "product_name", "category")
            .agg(F.sum("total_quantity").alias("total_quantity")))


def current_products(spark, sf):
    """Open versions of the product history: id, unique name, category."""
    return current_versions(product_history(spark, sf), ["product_id"], "valid_from", ["seq"]).select(
        "product_id", F.concat("product_name", F.lit(" #"), "product_id").alias("product_name"), "category")


DYN_AGG_SQL = f"""with o as ({STAR_SQL}),
cur as (select p_partkey as product_id, p_name || ' #' || p_partkey as product_name,
               case when p_size >= 45 then 'PROMO ' || p_type else p_type end as category from part)
select o.delivery_date, cur.product_name, cur.category, cast(sum(o.quantity) as bigint) as total_quantity
from o left join cur on o.product_id = cur.product_id
group by all"""


@query("dynamic_aggregate", covers="T10 A9 J5 W3", sql=DYN_AGG_SQL)
def dynamic_aggregate(spark, sf):
    """Dynamic aggregate: per batch of new warehouse order rows, delta sums by (date, product)
    are merged additively; product names/categories of the current versions join at read."""
    area = scratch_path(spark, "dynamic_aggregate")
    stg_path = f"{area}/stg_lines"
    orders_tbl = AppendTable(spark, f"{area}/orders_tbl")
    summary = PartitionedTable(spark, f"{area}/orders_summary_tbl", "delivery_month",
                               F.date_format("delivery_date", "yyyy-MM"))
    keys = ["delivery_date", "product_id"]
    for land_batch in _staged_lines_in_two_batches(spark, sf, stg_path):
        land_batch()
        incremental_map(change_stream(spark, stg_path, LINE_TABLE_SCHEMA),
                        lambda df: normalize_orders(df, partner_dim(spark, sf), product_dim(spark, sf)),
                        orders_tbl, f"{area}/_ckpt/join")
        incremental_aggregate(orders_tbl.stream(_ORDERS_TBL_SCHEMA),
                              lambda df: df.groupBy(*keys).agg(F.sum("quantity").alias("total_quantity")),
                              keys, ["total_quantity"], summary, f"{area}/_ckpt/agg")
    return summary_view(summary.read().drop("delivery_month"), current_products(spark, sf))


_ORDERS_TBL_SCHEMA = T.StructType([
    T.StructField("partner_id", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("delivery_date", T.DateType()), T.StructField("order_date", T.DateType()),
    T.StructField("quantity", T.LongType())])


def _append_observed(table_, df, batch_id) -> int:
    obs = Observation(f"rows_{batch_id}")
    written = table_.append(df.observe(obs, F.count(F.lit(1)).alias("n")), batch_id=batch_id)
    return int(obs.get["n"]) if written else 0


def version_dimension(history: AppendTable, feed: ChangeFeed) -> int:
    """Task body ``insert into DWH.<dim>_TBL select ... from <dim>_STREAM where action = 'INSERT'``: the INSERT images that wait in the
    change feed of the staging dimension are appended, with the version as the change sequence that orders equal-date
    versions, and the feed's offset moves. Returns the rows inserted."""
    return feed.consume(lambda changes, version: _append_observed(
        history, insert_images(changes).withColumn("change_seq", F.lit(version)), version)) or 0


def gated(log: RunLog, task: str, rows: int) -> None:
    """A step that found no new data is skipped: it logs nothing."""
    if rows:
        log.log_step(task, rows)


def run_layered_flow(spark, sf, area):
    """The chained steps of one scheduled run: copy -> (if new data) flatten -> version the
    product and partner tables from their change rows -> normalize -> summarise over the
    current product versions; every step is logged with its row count."""
    with sparing_disk(spark):
        return _layered_steps(spark, sf, area)


def _layered_steps(spark, sf, area):
    log = RunLog(spark, f"{area}/mgmt/pipeline_log", "PIPELINE_START_TASK")
    stg = layered_flatten(spark, sf, area, log)

    initial = F.lit(INITIAL_FROM).cast("date")
    products, partners = (AppendTable(spark, f"{area}/dwh/{n}_tbl") for n in ("product", "partner"))
    stg_products, stg_partners = (ManifestTable(spark, f"{area}/stg/{n}", [f"{n}_id"]) for n in ("product", "partner"))
    product_feed, partner_feed = (ChangeFeed(t, f"{area}/_offset/{n}", [f"{n}_id"]) for n, t in (("product", stg_products), ("partner", stg_partners)))
    stg_products.publish(table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.concat("p_name", F.lit(" #"), "p_partkey").alias("product_name"),
        F.col("p_type").alias("category"), "p_size", initial.alias("valid_from")), batch_key="first copy")
    stg_partners.publish(table(spark, sf, "customer").select(
        F.col("c_custkey").alias("partner_id"), F.col("c_name").alias("partner_name"), "c_mktsegment", initial.alias("valid_from")), batch_key="first copy")
    version_dimension(products, product_feed)           # the initial copies
    version_dimension(partners, partner_feed)
    large = stg_products.read(1).where("p_size >= 45").select(
        "product_id", "product_name", F.concat(F.lit("PROMO "), "category").alias("category"), "p_size", F.lit(CHANGE_FROM).cast("date").alias("valid_from"))
    stg_products.merge(large, ["product_id"], ["category", "valid_from"], batch_key="large sizes")
    gated(log, "INSERT_PRODUCT_TASK", version_dimension(products, product_feed))
    gated(log, "INSERT_PARTNER_TASK", version_dimension(partners, partner_feed))

    current = current_versions(products.read(), ["product_id"], "valid_from", ["change_seq"]).select("product_id", "product_name", "category")
    summary = SnapshotTable(spark, f"{area}/mgmt/orders_summary")
    staged, parts, counts = stg.read(), [], []
    with scratch_area(spark, "current") as made:
        current.write.parquet(f"{made}/products")           # each slice reads it
        current = spark.read.schema(current.schema).parquet(f"{made}/products")
        for lines in in_slices(staged, "delivery_date", staged.count(), SUMMARY_SLICES):       # a group of the summary has one delivery date
            orders_tbl = normalize_orders(lines, partner_dim(spark, sf), product_dim(spark, sf))
            counts.append(Observation(f"summary_rows_{len(counts)}"))
            parts.append(summary_view(orders_tbl.groupBy("delivery_date", "product_id")
                                      .agg(F.sum("quantity").alias("total_quantity")), current)
                         .observe(counts[-1], F.count(F.lit(1)).alias("n")))
        summary.publish(*parts)
    log.log_step("ORDERS_SUMMARY_TASK", sum(int(c.get["n"]) for c in counts))
    return summary, log


LAYERED_RUN_SQL = f"""with o as ({STAR_SQL}),
cur as (select p_partkey as product_id, p_name || ' #' || p_partkey as product_name,
               case when p_size >= 45 then 'PROMO ' || p_type else p_type end as category from part)
select o.delivery_date, cur.product_name, cur.category, cast(sum(o.quantity) as bigint) as total_quantity
from o left join cur on o.product_id = cur.product_id
group by all"""


@query("layered_run_end_to_end", covers="T12 L4 T7", sql=LAYERED_RUN_SQL)
def layered_run_end_to_end(spark, sf):
    summary, _ = run_layered_flow(spark, sf, scratch_path(spark, "layered_run"))
    return summary.read()


@query("run_summary_message", covers="A10 F5 L5 L4", sql=f"""
with ol as ({D.ORDER_LINES_SQL}),
b as (select count(*) filter (where order_date < date '{D.BATCH_SPLIT}') as l1,
             count(*) filter (where order_date >= date '{D.BATCH_SPLIT}') as l2 from ol),
e as (select cast(o.o_orderdate as date) < date '{D.BATCH_SPLIT}' as first, ceil(count(*) / {D.DOC_MAX_LINES}.0) as docs
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey group by l.l_orderkey, 1),
d as (select cast(coalesce(sum(docs) filter (where first), 0) as bigint) as d1, cast(coalesce(sum(docs) filter (where not first), 0) as bigint) as d2 from e),
pr as (select count(*) as n from part where p_size >= 45),
pipe as ({LAYERED_RUN_SQL})
select 'Task: COPY_ORDERS_TASK Rows processed: ' || d1 || chr(10) ||
       'Task: INSERT_ORDERS_STG_TASK Rows processed: ' || l1 || chr(10) ||
       'Task: COPY_ORDERS_TASK Rows processed: ' || d2 || chr(10) ||
       'Task: INSERT_ORDERS_STG_TASK Rows processed: ' || l2 || chr(10) ||
       'Task: INSERT_PRODUCT_TASK Rows processed: ' || pr.n || chr(10) ||
       'Task: ORDERS_SUMMARY_TASK Rows processed: ' || (select count(*) from pipe) || chr(10) as message
from b, d, pr""")
def run_summary_message_q(spark, sf):
    """Finalizer text of one run: a line per logged step, in log order."""
    _, log = run_layered_flow(spark, sf, scratch_path(spark, "run_summary"))
    return run_summary_message(log.read(), log.run_group_id).select("message")

"""Loading queries: staged CSV copy, scoped loads, external views, snapshots, upserts, load status.

Each query stages the rows of a shared table as files in a fresh folder below the shared
checkpoint root (the upload side), then runs the operator under test on those files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import latest_per_key, load_with_status, observed_upsert, upsert
from ..session import scratch_path
from ..sources.manifest import ManifestTable
from ..sources.partitioned import PartitionedTable
from ..sources.snapshot import AppendTable, SnapshotTable
from ..sources.stage import FileFormat, StageDirectory, create_external_view, land, read_stage, stage_listing
from ..sources.tables import table
from ..streaming.ingest import FileIngest, purge
from ..streaming.ledger import LedgerLoad, LoadFailedError
from . import domain as D
from .registry import query

ORDERS_CSV_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_price", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
])
ORDERS_COLS_SQL = ("o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status, "
                   "o_totalprice as total_price, cast(o_orderdate as date) as order_date")


def _orders_rows(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_price"),
                    F.to_date("o_orderdate").alias("order_date"))


@query("csv_copy_load", covers="S1 S2 S3 S4 S5 S8 S9 S16 S18 T2", sql=f"select {ORDERS_COLS_SQL} from orders")
def csv_copy_load(spark, sf):
    """Two deliveries of CSV files; the copy runs after each and once more with nothing new:
    every file is loaded exactly once."""
    area = scratch_path(spark, "csv_copy_load")
    fmt = FileFormat.csv(skip_header=True, delimiter=",", on_error="abort")
    rows = _orders_rows(spark, sf)
    ingest = FileIngest(spark, f"{area}/stage", f"{area}/orders_raw", f"{area}/_ckpt", fmt, ORDERS_CSV_SCHEMA)
    land(rows.filter(F.col("order_date") < F.lit(D.BATCH_SPLIT).cast("date")), ingest.stage_path, fmt)
    ingest.run()
    land(rows.filter(F.col("order_date") >= F.lit(D.BATCH_SPLIT).cast("date")), ingest.stage_path, fmt)
    ingest.run()
    ingest.run()   # no new files: appends nothing
    return ingest.read().select(*ORDERS_CSV_SCHEMA.names)


@query("load_time_column", covers="S8 S7", sql="""
select o_orderkey as order_id, 'status=' || o_orderstatus as folder, timestamp '2024-02-01 03:04:05.678901' as load_ts from orders""")
def load_time_column(spark, sf):
    """Each row of a load carries the load's time, here a given one, and the file it came from."""
    area = scratch_path(spark, "load_time")
    fmt = FileFormat.csv()
    land(_orders_rows(spark, sf), f"{area}/stage", fmt, partition_by=["status"])
    schema = T.StructType([f for f in ORDERS_CSV_SCHEMA.fields if f.name != "status"])
    rows = read_stage(spark, f"{area}/stage", schema, fmt, load_ts="2024-02-01 03:04:05.678901")
    return rows.select("order_id", F.regexp_extract("source_file_name", "^([^/]+)/", 1).alias("folder"), F.col("load_ts").cast("timestamp_ntz").alias("load_ts"))


@query("path_scoped_load", covers="S6", sql=f"""
select o_orderkey as order_id, o_custkey as customer_id, o_totalprice as total_price,
       cast(o_orderdate as date) as order_date from orders where o_orderstatus = 'F'""")
def path_scoped_load(spark, sf):
    """Files land in one folder per status; the load reads the ``status=F`` folder only."""
    area = scratch_path(spark, "path_scoped_load")
    fmt = FileFormat.csv()
    land(_orders_rows(spark, sf), f"{area}/stage", fmt, partition_by=["status"])
    schema = T.StructType([f for f in ORDERS_CSV_SCHEMA.fields if f.name != "status"])
    df = read_stage(spark, f"{area}/stage", schema, fmt, sub_path="status=F", with_file=False)
    return df


PART_SQL = "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part"


@query("external_view", covers="S14 S24", sql=PART_SQL)
def external_view(spark, sf):
    """Schema-on-read view with computed columns over header-less CSV files (positional fields)."""
    area = scratch_path(spark, "external_view")
    fmt = FileFormat.csv(skip_header=False)
    land(table(spark, sf, "part"), f"{area}/stage", fmt)
    raw = T.StructType([T.StructField(f"c{i + 1}", T.StringType()) for i in range(6)])
    v = create_external_view(spark, "part_ext", f"{area}/stage", raw, fmt, computed={
        "p_partkey": F.col("c1").cast("bigint"), "p_name": F.col("c2"), "p_brand": F.col("c3"),
        "p_type": F.col("c4"), "p_size": F.col("c5").cast("int"), "p_retailprice": F.col("c6").cast("double")})
    return spark.sql("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part_ext")


@query("materialized_snapshot", covers="S15 S21 S22", sql="select p_partkey, p_name, p_retailprice from part")
def materialized_snapshot(spark, sf):
    """Stored projection: refreshed as a new snapshot version; readers get the newest version."""
    snap = SnapshotTable(spark, scratch_path(spark, "materialized_snapshot"))
    proj = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    snap.publish(proj.filter(F.col("p_size") < 25))   # an earlier, partial refresh
    snap.publish(proj)                                # the refresh that counts
    return snap.read()


@query("load_audit", covers="S7 S26", sql="""
select 'status=' || o_orderstatus as load_unit, count(*) as rows_loaded from orders group by 1""")
def load_audit(spark, sf):
    """Copy history: rows per loaded file folder within the last hour, newest first."""
    area = scratch_path(spark, "load_audit")
    fmt = FileFormat.csv()
    land(_orders_rows(spark, sf), f"{area}/stage", fmt, partition_by=["status"])
    schema = T.StructType([f for f in ORDERS_CSV_SCHEMA.fields if f.name != "status"])
    ingest = FileIngest(spark, f"{area}/stage", f"{area}/raw", f"{area}/_ckpt", fmt, schema)
    ingest.run()
    loaded = ingest.read()
    per_file = (loaded.groupBy("source_file_name")
                .agg(F.count(F.lit(1)).alias("row_count"), F.max("load_ts").alias("last_load_time")))
    recent = per_file.filter(F.col("last_load_time") >= F.current_timestamp() - F.expr("INTERVAL 1 HOUR"))
    return (recent.groupBy(F.regexp_extract("source_file_name", r"^([^/]+)/", 1).alias("load_unit"))
            .agg(F.sum("row_count").alias("rows_loaded")))


@query("purge_load", covers="S10 S4", sql=f"select {ORDERS_COLS_SQL} from orders")
def purge_load(spark, sf):
    """``copy ... purge = true``: staged files are removed once their rows are committed; the
    stage is empty after the load, the target holds every row once."""
    area = scratch_path(spark, "purge_load")
    fmt = FileFormat.csv()
    ingest = FileIngest(spark, f"{area}/stage", f"{area}/orders_raw", f"{area}/_ckpt", fmt, ORDERS_CSV_SCHEMA,
                        purge=True)
    rows = _orders_rows(spark, sf)
    split = F.lit(D.BATCH_SPLIT).cast("date")
    land(rows.filter(F.col("order_date") < split), ingest.stage_path, fmt)
    ingest.run()
    land(rows.filter(F.col("order_date") >= split), ingest.stage_path, fmt)
    ingest.run()
    left = stage_listing(spark, ingest.stage_path).filter(F.col("name").endswith(".csv")).count()
    if left:
        raise RuntimeError(f"{left} staged files were not purged")
    return ingest.read().select(*ORDERS_CSV_SCHEMA.names)


STAGED_BYTES_SQL = "sum(length(o_orderkey::varchar || ',' || o_custkey || ',' || cast(cast(o_orderdate as date) as varchar)) + 1)"


def _keys_by_status(spark, sf):
    """Rows whose text in a file is known to the byte."""
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"))


@query("stage_listing", covers="S13", sql=f"""
select 'status=' || o_orderstatus as folder, cast({STAGED_BYTES_SQL} as bigint) as size, true as modified_lately from orders group by 1""")
def stage_listing_q(spark, sf):
    """``list @stage``: one file per status, with its size and time."""
    area = scratch_path(spark, "stage_listing")
    land(_keys_by_status(spark, sf).coalesce(1), f"{area}/stage", FileFormat.csv(skip_header=False), partition_by=["status"])
    files = stage_listing(spark, f"{area}/stage").filter(F.col("name").endswith(".csv"))
    lately = F.col("last_modified") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return files.select(F.regexp_extract("name", "/(status=[^/]+)/[^/]+$", 1).alias("folder"), "size", lately.alias("modified_lately"))


@query("named_table_append", covers="S22", sql=f"select {ORDERS_COLS_SQL} from orders")
def named_table_append(spark, sf):
    """A frame saved as a named table: created, replaced (overwrite), then extended (append)."""
    area = scratch_path(spark, "named_table")
    name = "daily_orders_" + area.rsplit("-", 1)[-1]
    rows, split = _orders_rows(spark, sf), F.lit(D.BATCH_SPLIT).cast("date")
    early, late = rows.filter(F.col("order_date") < split), rows.filter(F.col("order_date") >= split)
    for mode, part in (("error", late), ("overwrite", early), ("append", late)):
        part.write.mode(mode).option("path", f"{area}/{name}").saveAsTable(name)
    return spark.table(name)


@query("insert_literal_rows", covers="S16 S17 S18", sql="""
select n_nationkey as nation_id, n_name as nation_name, 'table' as origin from nation
union all select -1, 'UNKNOWN', 'literal' union all select -2, null, 'literal' union all select -3, 'SEA', 'local'""")
def insert_literal_rows(spark, sf):
    """A dimension copied from a table, with special members inserted as literal rows and as local rows."""
    nations = AppendTable(spark, f"{scratch_path(spark, 'literal_rows')}/nation_tbl")
    copied = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation_name"),
                                               F.lit("table").alias("origin"))
    nations.append(copied, batch_id=0)
    nations.append(spark.sql("select * from values (-1, 'UNKNOWN', 'literal'), (-2, null, 'literal') as t(nation_id, nation_name, origin)"),
                   batch_id=1)
    nations.append(spark.createDataFrame([(-3, "SEA", "local")], copied.schema), batch_id=2)
    return nations.read()


# ----------------------------------------------------------------------------- upserts
ORDER_LINE_KEYS = ["customer", "delivery_date", "baked_good_type"]
LINE_SCHEMA = T.StructType([
    T.StructField("customer", T.StringType()), T.StructField("order_date", T.DateType()),
    T.StructField("delivery_date", T.DateType()), T.StructField("baked_good_type", T.StringType()),
    T.StructField("quantity", T.LongType())])


def order_line_flow(spark, sf, area):
    """Batch order pipeline: two deliveries of order-line CSV files -> copy (each file once) -> merge
    into the keyed target after each delivery -> full-refresh summary. Returns (target, summary).

    The target is partitioned by delivery month (derived from the key), so a delivery only
    reads and rewrites the months it touches."""
    fmt = FileFormat.csv()
    lines = D.order_lines(spark, sf)
    ingest = FileIngest(spark, f"{area}/stage", f"{area}/orders_stg", f"{area}/_ckpt_copy", fmt, LINE_SCHEMA)
    target = PartitionedTable(spark, f"{area}/customer_orders", "delivery_month",
                              F.date_format("delivery_date", "yyyy-MM"))
    summary = SnapshotTable(spark, f"{area}/summary_orders")

    def merge_batch(batch, batch_id):
        batch = batch.select(*LINE_SCHEMA.names, "source_file_name", "load_ts")
        target.merge(batch, ORDER_LINE_KEYS, ["quantity", "source_file_name", "load_ts"],
                     update_exprs={"load_ts": F.current_timestamp()},
                     insert_exprs={"load_ts": F.current_timestamp()},
                     on_duplicate="latest", order_cols=["order_date", "quantity"],
                     batch_key=f"{ingest.checkpoint_path}#{batch_id}")      # a replayed batch is not merged again

    split = F.lit(D.BATCH_SPLIT).cast("date")
    land(lines.filter(F.col("order_date") < split), ingest.stage_path, fmt)
    ingest.run_each(merge_batch)
    land(lines.filter(F.col("order_date") >= split), ingest.stage_path, fmt)
    ingest.run_each(merge_batch)
    summary.publish(target.read().groupBy("delivery_date", "baked_good_type")
                    .agg(F.sum("quantity").alias("total_quantity")))
    return target, summary


_LATEST_SQL = f"""with ol as ({D.ORDER_LINES_SQL}),
latest as (select customer, delivery_date, baked_good_type,
                  max(struct_pack(o := order_date, q := quantity)) as w from ol group by all)"""


@query("orders_summary", covers="A1 S19 S4 J8 T12", sql=_LATEST_SQL + """
select delivery_date, baked_good_type, cast(sum(w.q) as bigint) as total_quantity from latest group by all""")
def orders_summary(spark, sf):
    _, summary = order_line_flow(spark, sf, scratch_path(spark, "orders_summary"))
    return summary.read()


@query("merge_latest_wins", covers="J8", sql=f"""with ol as ({D.ORDER_LINES_SQL}),
b1 as (select customer, delivery_date, baked_good_type, max(struct_pack(o := order_date, q := quantity)) as w
       from ol where order_date < date '{D.BATCH_SPLIT}' group by all),
b2 as (select customer, delivery_date, baked_good_type, max(struct_pack(o := order_date, q := quantity)) as w
       from ol where order_date >= date '{D.BATCH_SPLIT}' group by all)
select coalesce(b1.customer, b2.customer) as customer, coalesce(b1.w.o, b2.w.o) as order_date,
       coalesce(b1.delivery_date, b2.delivery_date) as delivery_date,
       coalesce(b1.baked_good_type, b2.baked_good_type) as baked_good_type,
       coalesce(b2.w.q, b1.w.q) as quantity
from b1 full outer join b2 using (customer, delivery_date, baked_good_type)""")
def merge_latest_wins(spark, sf):
    """Matched rows keep the target's order date; quantity comes from the latest source row."""
    lines = D.order_lines(spark, sf)
    split = F.lit(D.BATCH_SPLIT).cast("date")
    tgt = latest_per_key(lines.filter(F.col("order_date") < split), ORDER_LINE_KEYS, ["order_date", "quantity"])
    src = lines.filter(F.col("order_date") >= split)
    return upsert(tgt, src, ORDER_LINE_KEYS, ["quantity"], on_duplicate="latest", order_cols=["order_date", "quantity"])


def _orders_target_source(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           F.to_date("o_orderdate").alias("o_orderdate"))
    tgt = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))
    src = (o.filter(F.col("o_orderdate") >= F.lit(D.BATCH_SPLIT).cast("date"))
           .withColumn("o_totalprice", F.col("o_totalprice") + 1.0).withColumn("o_orderstatus", F.lit("U")))
    return tgt, src


@query("merge_upsert", covers="J8 X6", sql=f"""
with o as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate from orders),
tgt as (select * from o where o_orderdate < date '1999-01-01'),
src as (select o_orderkey, o_custkey, 'U' as o_orderstatus, o_totalprice + 1.0 as o_totalprice, o_orderdate
        from o where o_orderdate >= date '{D.BATCH_SPLIT}')
select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
       case when t.o_orderkey is not null then t.o_custkey else s.o_custkey end as o_custkey,
       case when s.o_orderkey is not null then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
       case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end as o_totalprice,
       case when t.o_orderkey is not null then t.o_orderdate else s.o_orderdate end as o_orderdate
from tgt t full outer join src s on t.o_orderkey = s.o_orderkey""")
def merge_upsert(spark, sf):
    tgt, src = _orders_target_source(spark, sf)
    return upsert(tgt, src, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("load_with_status", covers="X5 X6", sql=f"""
select 'Load Complete. ' || count(*) || ' rows affected' as status
from orders where cast(o_orderdate as date) >= date '{D.BATCH_SPLIT}'""")
def load_with_status_q(spark, sf):
    tgt, src = _orders_target_source(spark, sf)
    snap = SnapshotTable(spark, scratch_path(spark, "load_with_status"))
    msg = load_with_status(snap.publish, tgt, src, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
    return spark.createDataFrame([(msg,)], "status string")


@query("update_where", covers="P15", sql="""
select p_partkey, p_name, p_brand, case when p_size = 7 then 'DISCONTINUED' else p_type end as p_type,
       p_size, p_retailprice from part""")
def update_where(spark, sf):
    """``update part set p_type = 'DISCONTINUED' where p_size = 7`` on a table partitioned by size
    band: only the partitions holding matching rows are rewritten."""
    t = PartitionedTable(spark, scratch_path(spark, "update_where"), "size_band",
                         F.floor(F.col("p_size") / 10).cast("int"))
    t.publish(table(spark, sf, "part"))
    t.update_where(F.col("p_size") == 7, {"p_type": F.lit("DISCONTINUED")})
    return t.read().drop("size_band")


@query("stage_folders", covers="S13", sql="select distinct 'status=' || o_orderstatus as folder from orders")
def stage_folders(spark, sf):
    """Directory-table view of a stage: the folders that hold staged files."""
    area = scratch_path(spark, "stage_folders")
    land(_orders_rows(spark, sf), f"{area}/stage", FileFormat.csv(), partition_by=["status"])
    listing = stage_listing(spark, f"{area}/stage")
    return (listing.filter(F.col("name").endswith(".csv"))
            .select(F.regexp_extract("name", r"/(status=[^/]+)/[^/]+$", 1).alias("folder")).distinct())


_DATED_SQL = """select o_orderkey as order_id, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as order_date,
       o_totalprice as total_price, o_orderpriority from orders"""


@query("merge_null_keys", covers="J8", sql=f"""with o as ({_DATED_SQL})
select order_id, order_date, case when o_orderpriority = '1-URGENT' and order_date is not null then total_price + 100.0
                                  else total_price end as total_price from o
union all
select order_id, order_date, total_price + 100.0 from o where o_orderpriority = '1-URGENT' and order_date is null""")
def merge_null_keys(spark, sf):
    """Merge into a partitioned table where part of the keys has no date: a row whose key has a NULL never
    matches, so it is inserted once more, and what the NULL partition held stays."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("order_date"),
        F.col("o_totalprice").alias("total_price"), "o_orderpriority")
    target = PartitionedTable(spark, f"{scratch_path(spark, 'merge_null_keys')}/orders_tbl", "order_month",
                              F.date_format("order_date", "yyyy-MM"))
    target.publish(orders.drop("o_orderpriority"))
    urgent = (orders.filter(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority")
              .withColumn("total_price", F.col("total_price") + 100.0))
    target.merge(urgent, ["order_id", "order_date"], ["total_price"])
    return target.read().drop("order_month")


@query("update_moves_partition", covers="P15 J8", sql="""
select o_orderkey as order_id, case when o_orderstatus = 'P' then 'done' else o_orderstatus end as status,
       case when o_orderstatus = 'P' then o_totalprice + 1.0 else o_totalprice end as total_price from orders""")
def update_moves_partition(spark, sf):
    """An update of the partitioning column moves rows to another partition; a merge by the new key then
    finds them there."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                                               F.col("o_totalprice").alias("total_price"))
    target = PartitionedTable(spark, f"{scratch_path(spark, 'update_moves')}/orders_tbl", "state", F.col("status"))
    target.publish(orders)
    target.update_where(F.col("status") == "P", {"status": F.lit("done")})
    moved = (orders.filter(F.col("status") == "P").withColumn("status", F.lit("done"))
             .withColumn("total_price", F.col("total_price") + 1.0))
    target.merge(moved, ["order_id", "status"], ["total_price"])
    return target.read().drop("state")


@query("copy_history", covers="S26 S4 S9", sql="""
with f as (select o_orderstatus as status, count(*) as n from orders group by 1)
select 'daily_orders' as table_name, 'status=' || status as load_unit, 'LOADED' as status, n as rows_loaded, 0 as errors from f where status <> 'P'
union all
select 'daily_orders', 'status=P', 'LOAD_FAILED', 0, n from f where status = 'P'
union all
select 'daily_orders', 'status=P', 'LOADED', n, 0 from f where status = 'P'""")
def copy_history(spark, sf):
    """Copy history of one table within the last hour, from the ledger that the loads keep. A delivery whose dates cannot be
    read fails and is listed with its error; delivered again under the same names with other content it is loaded."""
    area = scratch_path(spark, "copy_history")
    fmt = FileFormat.csv()
    schema = T.StructType([f for f in ORDERS_CSV_SCHEMA.fields if f.name != "status"])
    rows = _orders_rows(spark, sf)
    target, other = (ManifestTable(spark, f"{area}/{n}", ["order_id"]) for n in ("orders_tbl", "other_tbl"))
    load = LedgerLoad(spark, f"{area}/stage", target, "daily_orders", schema, fmt)
    land(rows.filter("status <> 'P'"), load.stage_path, fmt, partition_by=["status"])
    load.run()
    broken = rows.filter("status = 'P'").withColumn("order_date", F.concat(F.lit("on "), F.col("order_date").cast("string")))
    land(broken, load.stage_path, fmt, partition_by=["status"])
    try:
        load.run()
    except LoadFailedError:
        pass                                       # the ledger has it
    purge(spark, load.pending().withColumnRenamed("file_size", "size"))
    land(rows.filter("status = 'P'"), load.stage_path, fmt, partition_by=["status"])
    load.run()
    load.run()                                     # nothing is pending
    LedgerLoad(spark, f"{area}/stage", other, "other_orders", schema, fmt).run()
    if target.read().count() != rows.count():
        raise RuntimeError("the table does not hold every order once")
    history = load.history(since=F.current_timestamp() - F.expr("INTERVAL 1 HOUR"))
    return (history.groupBy("table_name", F.regexp_extract("file_name", r"^([^/]+)/", 1).alias("load_unit"), "status")
            .agg(F.sum("row_count").alias("rows_loaded"), F.sum("error_count").alias("errors")))


@query("stage_directory", covers="S13 S14", sql=f"""
select 'status=' || o_orderstatus as folder, cast({STAGED_BYTES_SQL} as bigint) as bytes, count(*) as rows
from orders where o_orderstatus <> 'F' group by 1""")
def stage_directory(spark, sf):
    """Stored directory of a stage: files that came are listed, with their sizes, from the next refresh on, and so are files that went; the
    external table reads what the directory lists."""
    area = scratch_path(spark, "stage_directory")
    fmt = FileFormat.csv(skip_header=False)
    rows = _keys_by_status(spark, sf)
    directory = StageDirectory(spark, f"{area}/stage", f"{area}/directory")
    land(rows.filter("status <> 'O'"), directory.stage_path, fmt, partition_by=["status"])
    first = directory.refresh()
    land(rows.filter("status = 'O'"), directory.stage_path, fmt, partition_by=["status"])
    before = directory.files().count()
    purge(spark, directory.files().where(F.col("name").startswith("status=F/")))
    if before != first["added"] or directory.files().count() != before:
        raise RuntimeError("the directory changed without a refresh")
    second = directory.refresh()
    if not second["added"] or not second["removed"] or second["changed"]:
        raise RuntimeError(f"refresh reported {second}")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("order_date", T.DateType())])
    folder = F.regexp_extract(F.col("source_file_name"), "^([^/]+)/", 1).alias("folder")
    counted = directory.read(schema, fmt).groupBy(folder).agg(F.count("order_date").alias("rows"))
    sizes = directory.files().groupBy(F.regexp_extract("name", "^([^/]+)/", 1).alias("folder")).agg(F.sum("size").alias("bytes"))
    return sizes.join(counted, "folder").select("folder", "bytes", "rows")

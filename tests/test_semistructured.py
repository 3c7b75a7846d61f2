import datetime as dt
import json
import os

import pytest
from pyspark.sql import types as T

from layerkit.operators.semistructured import (csv_text_to_rows, flatten_items, flatten_partner_orders,
                                               keyed_document_columns, review_payload_rows, vget)
from layerkit.sources.stage import FileFormat, read_stage

D = dt.date


def partner_doc():
    """A pretty-printed partner order of our own: 3 delivery days, 1 + 2 + 3 lines."""
    days = {"2031-03-02": [("Lamp", 6)], "2031-03-09": [("Rope", 15), ("Lamp", 1)], "2031-04-01": [("Nail", 500), ("Rope", 2), ("Saw", 3)]}
    return {"Customer": "Harbour Stores", "Order date": "2031-02-27", "Orders": [
        {"Delivery date": d, "Orders by day": [{"Baked good type": g, "Quantity": q} for g, q in lines]} for d, lines in days.items()]}


def write(path, name, obj, pretty=True):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps(obj, indent="\t") if pretty else json.dumps(obj) + "\n")


def test_two_level_flatten_of_pretty_printed_document(spark, local_dir):
    write(local_dir, "harbour.json", partner_doc())
    raw = read_stage(spark, local_dir, None, FileFormat.json(multi_line=True), variant_col="customer_orders")
    flat = flatten_partner_orders(raw)
    rows = flat.collect()
    assert len(rows) == 6
    by_day = {}
    for r in rows:
        by_day[r.delivery_date] = by_day.get(r.delivery_date, 0) + int(r.quantity)
    assert by_day == {D(2031, 3, 2): 6, D(2031, 3, 9): 16, D(2031, 4, 1): 505}
    assert {r.source_file_name for r in rows} == {"harbour.json"}
    assert flat.schema["quantity"].dataType == T.DecimalType(38, 0)
    # wrong-case key gives NULL
    assert raw.select(vget("customer_orders", "Order Date", "date").alias("d")).first().d is None


def test_keyed_items_and_shape_probe(spark, local_dir):
    write(local_dir, "o1.json", {"Order id": "k-7", "Order datetime": "2031-05-06 07:08:09",
                                 "Items": [{"Item": "Saw", "Quantity": 2}, {"Item": "Lamp", "Quantity": 1}, {"Item": "Nail", "Quantity": 80}]})
    write(local_dir, "o2.json", {"Order id": "k-8", "Order datetime": "2031-05-06 09:00:00", "Items": []})
    write(local_dir, "o3.json", partner_doc())       # a differently shaped document in the same folder
    raw = read_stage(spark, local_dir, None, FileFormat.json(multi_line=True), variant_col="v")
    keyed = keyed_document_columns(raw, "v")
    assert keyed.filter("order_datetime is null").count() == 1
    items = flatten_items(keyed).collect()
    assert sorted((r.order_id, r.baked_good_type, r.quantity) for r in items) == [
        ("k-7", "Lamp", 1), ("k-7", "Nail", 80), ("k-7", "Saw", 2)]   # empty item list vanishes
    assert items[0].order_datetime == dt.datetime(2031, 5, 6, 7, 8, 9)


def test_csv_text_to_rows_trims_and_types(spark):
    text = "who,ordered,due,good,pieces\n   Quay Ltd,2031-01-05,2031-02-01,rope,12\nMill & Co ,2031-01-07,2031-01-30,saw,1\n Quay Ltd,2031-01-08,2031-02-01,nail,900"
    schema = T.StructType([T.StructField("customer", T.StringType()), T.StructField("order_date", T.DateType()),
                           T.StructField("delivery_date", T.DateType()), T.StructField("item", T.StringType()),
                           T.StructField("quantity", T.IntegerType())])
    out = csv_text_to_rows(spark.createDataFrame([(text,)], "t string"), "t", schema).collect()
    assert [tuple(r) for r in out] == [("Quay Ltd", D(2031, 1, 5), D(2031, 2, 1), "rope", 12),
                                       ("Mill & Co", D(2031, 1, 7), D(2031, 1, 30), "saw", 1),
                                       ("Quay Ltd", D(2031, 1, 8), D(2031, 2, 1), "nail", 900)]


def test_review_payload_rows(spark):
    search = json.dumps({"businesses": [{"id": "b1", "name": "Bakery One"}, {"id": "b2", "name": "Other"}]})
    reviews = json.dumps({"reviews": [{"user": {"name": "ann"}, "text": "Great bread", "rating": 5},
                                      {"user": {"name": "bo"}, "text": "fine", "rating": 3}]})
    out = review_payload_rows(spark.createDataFrame([(search, reviews)], "search_json string, reviews_json string"))
    assert sorted(tuple(r) for r in out.collect()) == [("b1", "Bakery One", "ann", "Great bread", 5),
                                                       ("b1", "Bakery One", "bo", "fine", 3)]


def test_typed_and_variant_flatten_agree(spark, local_dir):
    from layerkit.operators.semistructured import flatten_partner_orders_typed, partner_document_schema
    write(local_dir, "harbour.json", partner_doc())
    raw = read_stage(spark, local_dir, None, FileFormat.json(multi_line=True), variant_col="customer_orders")
    typed = read_stage(spark, local_dir, partner_document_schema(), FileFormat.json(multi_line=True))
    a = sorted(tuple(r) for r in flatten_partner_orders(raw).drop("load_ts").collect())
    b = sorted(tuple(r) for r in flatten_partner_orders_typed(typed).drop("load_ts").collect())
    assert a == b and len(a) == 6


@pytest.mark.parametrize("change", ["quantity", "object"])
def test_bad_values_abort_the_flatten(spark, local_dir, change):
    doc = partner_doc()
    if change == "quantity":
        doc["Orders"][1]["Orders by day"][0]["Quantity"] = "abc"
    else:
        doc["Orders"] = doc["Orders"][0]             # one object instead of an array
    write(local_dir, "bad.json", doc)
    raw = read_stage(spark, local_dir, None, FileFormat.json(multi_line=True), variant_col="customer_orders")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        flatten_partner_orders(raw).collect()


def test_file_names_with_blanks_and_marks(spark, local_dir):
    folder = os.path.join(local_dir, "my stage+x")
    write(folder, "Orders 1+2 50%.json", partner_doc())
    raw = read_stage(spark, folder, None, FileFormat.json(multi_line=True), variant_col="v")
    assert [r.source_file_name for r in raw.collect()] == ["Orders 1+2 50%.json"]

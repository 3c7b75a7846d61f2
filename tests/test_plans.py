"""Plan properties of every registered query: no Cartesian products or nested-loop joins, no
row-at-a-time Python UDFs; filters reach the Parquet scans of the shared tables."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from layerkit.plans import catalog

from .conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_no_row_udf(spark, name):
    text = plan_text(E.queries()[name](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad} in plan"


def test_filters_and_pruning_reach_the_scan(spark):
    text = plan_text(E.queries()["filtered_sum"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,42)]" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_semi_join_aggregates_before_the_join(spark):
    text = plan_text(E.queries()["semi_join_having"](spark, SF001))
    # partial aggregation of the sales happens below the semi-join
    assert text.index("LeftSemi") < text.rindex("HashAggregate")

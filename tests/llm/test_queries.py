"""Every registered training-data query runs at sf0.001; those with SQL match DuckDB."""

import duckdb
import pytest

from layerkit.llm import catalog
from layerkit.sources.tables import TABLES

from ..conftest import SF001
from ..test_plans import FORBIDDEN, plan_text
from ..test_queries import _bag

NATIVE = ("op4_", "op5_", "op9_", "op10_", "op13_")
OTHER_ROWS = ("op11_", "op12_")        # a row per word, or per item and place


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF001)
    text = plan_text(df)
    assert not any(bad in text for bad in FORBIDDEN), name
    if name.startswith(NATIVE):
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    assert name.startswith(OTHER_ROWS) or len(rows) == con.execute("select count(*) from documents").fetchone()[0]
    if name in catalog.ORACLE:
        res = con.execute(catalog.ORACLE[name])
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols)
        assert _bag(df.columns, rows) == _bag(cols, res.fetchall())

"""The driver contract: names, oracles and coverage tags of the registered queries."""

import re

import __spark_entry__ as E
from layerkit.plans import catalog


def test_oracles_belong_to_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_every_query_names_the_operators_it_covers():
    ids = re.compile(r"^[SPJAWOUFTXNGLD]\d+$")
    for name, cov in catalog.covers().items():
        tags = cov.split()
        assert tags and all(ids.match(t) for t in tags), name


def test_query_names():
    for name in catalog.queries():
        assert re.match(r"^[a-z][a-z0-9_]*$", name) and not re.match(r"^op\d", name) and "pipeline" not in name

"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from . import q_changes, q_load, q_misc, q_relational, q_semistructured, q_sql, q_streaming, q_tables  # noqa: F401
from .registry import COVERS, ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)


def covers():
    return dict(COVERS)

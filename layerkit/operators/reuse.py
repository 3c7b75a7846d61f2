"""Explicit reuse of an earlier result (the reference's result reuse switched on/off).

Spark has no transparent result cache: a result used by several actions is persisted for
the duration of a block and released after it. MEMORY_AND_DISK keeps it correct when an
executor is lost (lost blocks are recomputed from lineage).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()

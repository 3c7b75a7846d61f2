"""Intermediate tables of the operators: Parquet below ``spark.checkpoint.dir``.

A written table cuts the lineage, is columnar and compressed, and is read again by any executor, so
the loss of an executor repeats at most the tasks of one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows and bytes of one Arrow batch: bounds the memory of a Python worker on long texts.
ARROW_ROWS, ARROW_BYTES = 2000, 16 << 20

DOCUMENT_COLUMNS = ("doc_id", "text")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_arrow(df: DataFrame) -> DataFrame:
    """Bounds the Arrow batches of this session before a Python step over whole texts."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a null text as empty; other columns play no part."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))

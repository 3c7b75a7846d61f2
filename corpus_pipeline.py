"""From raw documents to training tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``:

1. toxicity: documents predicted toxic go (labels of the folder, held-out rows never learned from);
2. exact_dedup: of equal texts the row with the largest doc_id stays;
3. near_dedup: one document of each group of near-duplicates stays;
4. mix: a row for each copy that the mix takes, range-sorted by training position;
5. encode: doc_id, n_tokens and the token ids (little-endian unsigned 32-bit integers), one row per copy, and
   position: the place of the copy in the training order. A scan does not keep the order of files, so it is taken
   from the numbers of the file and the row in it (ascending, with gaps between files). Rows of files without such
   numbers, and of frames that come from no file, count in the order in which Spark reads them; a column of the input that is
   called position plays no part.

No SQL states the first and third stage at full size, so ORACLE_SQL is None; the whole run is tested
against brute force.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import bpe, exactdedup, mixing, neardup, toxicity
from layerkit.llm.scratch import written
from layerkit.sources.tables import table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdedup.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def number(pattern: str):
        return F.regexp_extract("_metadata.file_name", pattern, 1).try_cast("long")

    as_read = F.monotonically_increasing_id()
    try:
        # part (a task of the sort), file of the task, row: 2^12 files of 2^32 rows a task
        place = (number("^part-([0-9]+)-") * (1 << 12) + number("-c([0-9]+)[.]")) * (1 << 32) + F.col("_metadata.row_index")
        rows = docs.select("doc_id", "text", F.coalesce(place, as_read).alias("position"))
    except AnalysisException:                      # not read from files
        rows = docs.select("doc_id", "text", as_read.alias("position"))
    return bpe.encode(rows, carry=("position",))


STAGES = [("toxicity", remove_toxic), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

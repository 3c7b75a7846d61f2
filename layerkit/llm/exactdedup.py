"""Exact dedup by a heavy-hitter split (DataFrame functions only).

1. Every whole text is reduced to its SHA-256 digest (32 bytes); texts are equal when identical.
2. A Misra-Gries style summary (``approx_top_k``: a bounded table of counters, merged from map-side
   partial summaries) proposes at most ``heavy`` frequent digests. With ``counters`` counters every
   digest that holds more than about ``rows / counters`` rows is among the proposals.
3. The proposals are verified: exact count and winner (largest doc_id) from one aggregation that is
   combined map-side. At most ``heavy`` rows, so the broadcast has a proven size bound.
4. Rows of a verified heavy digest meet their winner map-side, without a shuffle; all other digests
   go through an ordinary shuffle, where no group holds more than about ``rows / heavy`` rows.

Defined results: a null text counts as empty; rows that repeat a doc_id with an equal text belong to
one group and all rows that carry the winning doc_id are marked kept; a group whose doc_ids are all
null keeps them all (there is nothing to choose by); an empty table gives an empty result. Extra
columns, of any name, take no part in :func:`exact_groups`; :func:`exact_dedup` returns them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import texts, written

HEAVY = 1000        # digests handled map-side at most (bounds the broadcast: about 100 bytes each)
COUNTERS = 4000     # counters of the summary
FIRST_LEVEL = 64    # partial summaries are merged in so many tasks before the last one


def digests(docs: DataFrame) -> DataFrame:
    t = texts(docs)
    return t.select("doc_id", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest"))


def heavy_digests(hashed: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests: (digest, keep_id, group_size), at most ``heavy`` rows."""
    # the summary counts the leading 60 bits of the digest; the verification compares whole digests
    lead = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    marked = hashed.withColumn("lead", lead)
    partial = (marked.groupBy(F.pmod(F.spark_partition_id(), F.lit(FIRST_LEVEL)).alias("part"))
               .agg(F.expr(f"approx_top_k_accumulate(lead, {counters})").alias("summary")))
    # grouped, not global: an empty task then adds no summary of nothing
    top = (partial.groupBy((F.col("part") * 0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {counters})").alias("summary"))
           .select(F.expr(f"approx_top_k_estimate(summary, {heavy})").alias("top")))
    proposed = top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("lead")).where("lead is not null")
    return (marked.join(F.broadcast(proposed), "lead")
            .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .where("group_size > 1"))


def exact_groups(docs: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    hashed = written(digests(docs), "op10-digests")
    winners = written(heavy_digests(hashed, heavy, counters), "op10-heavy")
    mapside = hashed.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    rest = (hashed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
            .select("digest", "doc_id", F.max("doc_id").over(same).alias("keep_id"),
                    F.count(F.lit(1)).over(same).alias("group_size")))
    return (mapside.select("digest", "doc_id", "keep_id", "group_size").unionByName(rest)
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay. A row is judged by its doc_id and its text, so rows that
    repeat both stay or go together."""
    dropped = (exact_groups(docs, **options).where("not kept")
               .select(F.col("doc_id").alias("__dropped"), F.col("text_sha256").alias("__digest")).distinct())
    digest = F.sha2(F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8"), 256)
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["__dropped"]) & (digest == dropped["__digest"]), "left_anti")


ORACLE = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256)
select d.doc_id, g.keep_id, g.group_size, d.doc_id is not distinct from g.keep_id as kept, d.text_sha256
from d join g using (text_sha256)
"""

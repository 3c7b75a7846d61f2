"""Line dedup over the whole corpus (DataFrame functions only).

1. Every whole text is split at ``\\n`` and its lines are exploded with their positions. A line's key is the
   line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; keys shorter than ``least_chars`` code
   points are never dropped. Two independent hashes (64 and 32 bits) stand for the key from here on.
2. Documents are counted once per hash: repeats inside a task are combined before the shuffle, which deals
   by hash *and* document, so a line that a third of all documents share is spread over all tasks.
3. Hashes found in ``most_docs`` documents or more mark (document, position); the positions of a document
   are gathered as a set, bounded by its own lines. Text is not exploded again: one join by document
   brings the positions to the text, and the lines that stay are put together by position.

Defined results: a null or empty text is one empty line, which stays; rows that share a doc_id are one
document for the count (null ids: rows with an equal text are one), each row is returned; a text whose
lines all go becomes empty; a null text stays null; an empty table gives an empty result. Extra columns,
of any name, play no part and come back unchanged from :func:`dedup_lines`. There are no ties to break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

MOST_DOCS = 10      # a line in so many documents goes
LEAST_CHARS = 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    # lower() knows more letters than A-Z; on ASCII it is the same and much cheaper
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _rows(docs: DataFrame) -> DataFrame:
    """One row per document row: doc (all its columns), doc_id, lines, and a row key of 96 bits."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("doc_id"), text.alias("whole"),
                       F.xxhash64(docs["doc_id"], text).alias("r1"), F.hash(docs["doc_id"], text).alias("r2"))


def frequent_lines(lines: DataFrame, most_docs: int) -> DataFrame:
    """(k1, k2): hashes of keys in ``most_docs`` documents or more."""
    return (lines.groupBy("k1", "k2").agg(F.countDistinct(F.coalesce("doc_id", F.lit(0)), F.when(F.col("doc_id").isNull(), F.col("r1")).otherwise(0)).alias("n"))
            .where(F.col("n") >= most_docs).select("k1", "k2"))


def cleaned(docs: DataFrame, most_docs: int = MOST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc (struct of all columns), kept_text, n_lines, n_dropped: one row per row of ``docs``."""
    rows = _rows(docs)
    line = rows.select("doc_id", "r1", "r2", F.posexplode(F.split("whole", "\n", -1)).alias("at", "line"))
    keyed = line.select("doc_id", "r1", "r2", "at", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= max(1, least_chars))
    lines = written(keyed.select("doc_id", "r1", "r2", "at", F.xxhash64("key").alias("k1"), F.hash("key").alias("k2")), "op13-lines")
    # a written table has a known size: Spark broadcasts it below its threshold only
    frequent = written(frequent_lines(lines, most_docs), "op13-frequent")
    gone = lines.join(frequent, ["k1", "k2"], "left_semi").groupBy("r1", "r2").agg(F.collect_set("at").alias("gone"))
    split = F.split("whole", "\n", -1)
    joined = rows.join(written(gone, "op13-gone"), ["r1", "r2"], "left").select(
        "doc", "whole", "gone", F.when(F.col("gone").isNotNull(), split).alias("lines"),
        (F.length("whole") - F.length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.col("lines")[i])
    return joined.select("doc", F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(stay, "\n")).alias("kept_text"),
                         "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``; all other columns as they were."""
    out = cleaned(docs, **options)
    return out.select(*[F.when(F.col("doc.text").isNotNull(), F.col("kept_text")).alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = """
with l as (
  select d.doc_id, u.pos, d.lines[u.pos] as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents) d, unnest(range(1, len(d.lines) + 1)) as u(pos)
), k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key from l
), f as (
  select line_key from k where length(line_key) >= 1 group by line_key having count(distinct doc_id) >= 10
), m as (
  select k.*, f.line_key is not null as gone from k left join f on k.line_key = f.line_key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""

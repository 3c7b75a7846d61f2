"""Substring dedup on the De Bruijn graph of word k-mers, compacted through joins.

An edge is a window of ``K`` = 50 words; a window of a document is a repeat when its word sequence also
occurs in a document with a smaller doc_id. Every word covered by a repeat is removed.

1. Each text is cut into *runs*: maximal sequences of consecutive edges with the same minimiser (the
   smallest hash of the 25-word sequences inside the window). A run is a path of the graph; equal windows
   have equal minimisers, so equal edges always lie in runs of the same minimiser. A run is described by
   its minimiser, a fingerprint of its whole word sequence, and its source coordinate (doc_id, word).
2. Minimisers of a single document cannot hold a repeat and go. The others are *classes* of equal runs with
   their source, the smallest (doc_id, word).
3. Classes that occur in several documents are compacted: a node between two classes is nonbranching
   when every occurrence of the first goes on with the second and every occurrence of the second comes
   from the first. Both facts are joined, and the chains of nonbranching nodes, which lie side by side in
   their common source document, become one path with one source coordinate.
4. A document that holds a path (or class) with an earlier source loses its words. Where one minimiser has
   several classes, the runs differ somewhere but may share edges: for the source occurrence of each
   such class the single edges are compared.
5. Every span is verified at its coordinates: an independent digest (BLAKE2b, 128 bits) of the words at the occurrence
   must be that of the words at the source; spans that differ (a collision of 64-bit hashes) go.
6. Spans meet the texts by doc_id; the words they cover are removed.

Hot minimisers (a passage of a third of all documents) are aggregated map-side or joined by joins that
Spark can split; no step gathers the occurrences of a key. Windows over a document are bounded by it.

Defined results: a null or empty text has no words; documents with fewer than 50 words lose nothing;
rows that repeat a doc_id count as one document, and their spans are joined to each row's own text only
where its fingerprint (of the text) is the same; a null doc_id is never a source and loses nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import bound_arrow, texts, written
from .words import ragged, span_hashes, window_hashes, word_batches

K, MINIMISER = 50, 25


def _window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values, by doubling."""
    low, span = grams, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def _run_table(w, k: int, m: int):
    """(row, first word, edges, minimiser, fingerprint) of the runs of a piece of texts."""
    n = len(w.hashes)
    empty = np.zeros(0, np.int64)
    if n < k:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    low = _window_minima(window_hashes(w.hashes, m), k - m + 1)       # one per window of k words
    row = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    inside = row[:n - k + 1] == row[k - 1:]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (low[1:] != low[:-1]) | (row[1:n - k + 1] != row[:n - k])
    starts = np.flatnonzero(first)
    # a run ends before the next run or the first window that leaves the row
    stops = np.append(starts[1:], n - k + 1)
    last_inside = w.bounds[1:][row[starts]] - k + 1
    stops = np.minimum(stops, last_inside)
    marks = span_hashes(w.hashes, starts, stops + k - 1)
    return row[starts], starts - w.bounds[:-1][row[starts]], stops - starts, low[starts], marks


def _runs(k: int, m: int):
    def run(batches):
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for w in word_batches(batch.column("text")):
                row, word, edges, minimiser, mark = _run_table(w, k, m)
                at = pa.array(row + w.first)
                yield pa.record_batch([ids.take(at), keys.take(at), pa.array(word, pa.int32()), pa.array(edges, pa.int32()),
                                       pa.array(minimiser.view(np.int64)), pa.array(mark.view(np.int64))],
                                      names=["doc_id", "text_key", "word", "edges", "minimiser", "mark"])
    return run


def _single_edges(k: int):
    """The edges of the given runs of each text."""
    def run(batches):
        for batch in batches:
            ids, keys, want = batch.column("doc_id"), batch.column("text_key"), batch.column("runs")
            for w in word_batches(batch.column("text")):
                grams = window_hashes(w.hashes, k)
                for i in range(len(w.bounds) - 1):
                    runs = want[w.first + i].values
                    word, edges = (runs.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("word", "edges"))
                    minimiser = np.repeat(runs.field("minimiser").to_numpy(zero_copy_only=False), edges)
                    at = ragged(word, edges)
                    # a row per distinct edge of the document, with the words where it starts
                    edge, group = np.unique(grams[at + w.bounds[i]], return_inverse=True)
                    order = np.argsort(group, kind="stable")
                    offsets = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(edge))))).astype(np.int32)
                    n = len(edge)
                    yield pa.record_batch([pa.array([ids[w.first + i].as_py()] * n, pa.int64()),
                                           pa.array([keys[w.first + i].as_py()] * n, pa.int64()),
                                           pa.ListArray.from_arrays(offsets, pa.array(at[order], pa.int32())),
                                           pa.array(minimiser[order][offsets[:-1]], pa.int64()), pa.array(edge.view(np.int64))],
                                          names=["doc_id", "text_key", "words_at", "minimiser", "edge"])
    return run


def _keep(batches):
    """Words outside the spans: counts, and the kept words joined by blanks."""
    for batch in batches:
        spans = batch.column("spans")
        counts, gone, kept = [], [], []
        for w in word_batches(batch.column("text")):
            raw = w.data.tobytes()
            for i, (lo, hi) in enumerate(zip(w.bounds[:-1], w.bounds[1:])):
                change = np.zeros(hi - lo + 1, dtype=np.int64)
                own = spans[w.first + i].values
                if own is not None and len(own):
                    a = own.field("word").to_numpy(zero_copy_only=False)
                    b = a + own.field("words").to_numpy(zero_copy_only=False)
                    np.add.at(change, a, 1)
                    np.add.at(change, b, -1)
                stay = np.flatnonzero(np.cumsum(change)[:hi - lo] == 0) + lo
                counts.append(hi - lo)
                gone.append(hi - lo - len(stay))
                kept.append(b" ".join([raw[a:b] for a, b in zip(w.starts[stay].tolist(), w.ends[stay].tolist())]))
        yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                               pa.array([x.decode("utf-8", "surrogatepass") for x in kept], pa.string())],
                              names=["doc_id", "n_words", "n_removed", "kept_text"])


def _digests(batches):
    """Digests of the words of the wanted spans of each text, joined by one blank."""
    for batch in batches:
        ids, keys, want = batch.column("doc_id"), batch.column("text_key"), batch.column("spans")
        for w in word_batches(batch.column("text")):
            raw = w.data.tobytes()
            for i, (lo, hi) in enumerate(zip(w.bounds[:-1], w.bounds[1:])):
                starts, ends = w.starts[lo:hi], w.ends[lo:hi]
                plain = b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
                at = np.concatenate(([0], np.cumsum(ends - starts + 1)))
                spans = want[w.first + i].values
                word, words = (spans.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("word", "words"))
                inside = word + words < len(at)                 # a false claim may reach beyond its text
                word, words = word[inside], words[inside]
                marks = [hashlib.blake2b(plain[a:b - 1], digest_size=16).digest() for a, b in zip(at[word].tolist(), at[word + words].tolist())]
                n = len(marks)
                yield pa.record_batch([pa.array([ids[w.first + i].as_py()] * n, pa.int64()), pa.array([keys[w.first + i].as_py()] * n, pa.int64()),
                                       pa.array(word, pa.int32()), pa.array(words, pa.int32()), pa.array(marks, pa.binary())],
                                      names=["doc_id", "text_key", "word", "words", "digest"])


def verified(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans (doc_id, text_key, word, words, source_doc, source_key, source_word) whose words are those at their source."""
    at = ["doc_id", "text_key", "word", "words"]
    origin = spans.select(F.col("source_doc").alias("doc_id"), F.col("source_key").alias("text_key"), F.col("source_word").alias("word"), "words")
    wanted = (spans.select(*at).unionByName(origin).distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("word", "words")).alias("spans")))
    texts_of = _keyed(docs).where("doc_id is not null").join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    digests = written(bound_arrow(texts_of.select("doc_id", "text_key", "text", "spans")).mapInArrow(
        _digests, "doc_id long, text_key long, word int, words int, digest binary"), "op1-digests")
    there = digests.select(*[F.col(a).alias(b) for a, b in zip(at, ["source_doc", "source_key", "source_word", "words"])], F.col("digest").alias("source_digest"))
    return (spans.join(digests, at).join(there, ["source_doc", "source_key", "source_word", "words"]).where("digest = source_digest")
            .select(*at, "source_doc", "source_word"))


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("text_key", F.xxhash64("text"))


def runs(docs: DataFrame, k: int = K, minimiser: int = MINIMISER) -> DataFrame:
    return bound_arrow(_keyed(docs).where("doc_id is not null").select("doc_id", "text_key", "text")).mapInArrow(
        _runs(k, minimiser), "doc_id long, text_key long, word int, edges int, minimiser long, mark long")


def compact(occurrences: DataFrame, k: int = K) -> DataFrame:
    """Paths of repeated classes: (doc_id, text_key, word, words, source_doc, source_key, source_word) per occurrence.

    ``occurrences`` are runs of classes that occur in several documents, with their source."""
    along = Window.partitionBy("doc_id", "text_key").orderBy("word")
    here = F.struct("minimiser", "mark")
    following = F.when(F.lead("word").over(along) == F.col("word") + F.col("edges"), F.lead(here).over(along))
    previous = F.when(F.lag("word").over(along) + F.lag("edges").over(along) == F.col("word"), F.lag(here).over(along))
    linked = written(occurrences.withColumn("following", following).withColumn("previous", previous), "op1-linked")
    # unique successor and predecessor over all occurrences; a missing one counts as another
    only = lambda c: (F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c))
    ends = (linked.groupBy("minimiser", "mark", "source", "edges")
            .agg(F.when(only("following"), F.min("following")).alias("following"),
                 F.when(only("previous"), F.min("previous")).alias("previous")))
    ends = written(ends, "op1-ends")
    after = ends.where("following is not null").select(
        F.col("following.minimiser").alias("minimiser"), F.col("following.mark").alias("mark"),
        F.struct("minimiser", "mark").alias("previous"), F.lit(True).alias("nonbranching"))
    nodes = ends.join(after, ["minimiser", "mark", "previous"], "left")
    joins = F.coalesce("nonbranching", F.lit(False))
    source_order = Window.partitionBy("source.doc_id", "source.text_key").orderBy("source.word")
    # linked classes lie side by side in their source; anything else starts a path
    starts = ~joins | F.coalesce(F.lag(F.col("source.word") + F.col("edges")).over(source_order) != F.col("source.word"), F.lit(True))
    chained = nodes.withColumn("starts", starts).withColumn(
        "path", F.sum(F.col("starts").cast("int")).over(source_order))
    paths = (chained.groupBy("source.doc_id", "source.text_key", "path")
             .agg(F.min("source").alias("path_source"), F.sum("edges").alias("path_edges")))
    heads = (chained.where("starts").select("minimiser", "mark", "source", "path")
             .join(paths.select(F.col("path_source").alias("source"), "path_edges"), "source"))
    return (linked.select("doc_id", "text_key", "word", "minimiser", "mark").join(heads, ["minimiser", "mark"])
            .select("doc_id", "text_key", "word", (F.col("path_edges") + k - 1).cast("int").alias("words"),
                    F.col("source.doc_id").alias("source_doc"), F.col("source.text_key").alias("source_key"), F.col("source.word").alias("source_word")))


def repeated_spans(docs: DataFrame, k: int = K, minimiser: int = MINIMISER) -> DataFrame:
    """Spans to remove: doc_id, text_key, word, words, and where they stand first: source_doc, source_word."""
    every = written(runs(docs, k, minimiser), "op1-runs")
    shared = (every.groupBy("minimiser").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
              .select("minimiser"))
    found = written(every.join(shared, "minimiser"), "op1-shared")
    source = F.min(F.struct("doc_id", "text_key", "word"))
    classes = written(found.groupBy("minimiser", "mark").agg(source.alias("source"), F.max("doc_id").alias("last_doc")), "op1-classes")
    several = classes.groupBy("minimiser").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    found = written(found.join(classes, ["minimiser", "mark"]).join(several, "minimiser", "left"), "op1-placed")

    whole = (compact(found.where("last_doc > source.doc_id").drop("last_doc", "classes"), k)
             .where(F.col("doc_id") > F.col("source_doc")))

    # single edges: only the documents in which a class stands first, where its minimiser has other classes
    first = (found.where((F.col("classes") > 1) & (F.col("doc_id") == F.col("source.doc_id")))
             .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("word", "edges", "minimiser")).alias("runs")))
    edges = bound_arrow(_keyed(docs).join(first, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])).mapInArrow(
        _single_edges(k), "doc_id long, text_key long, words_at array<int>, minimiser long, edge long")
    edges = written(edges, "op1-edges")
    stands = F.struct("doc_id", "text_key", F.col("words_at")[0].alias("word"))
    earliest = (edges.groupBy("minimiser", "edge").agg(F.min(stands).alias("source"), F.max("doc_id").alias("last_doc"))
                .where("last_doc > source.doc_id"))
    single = (edges.join(earliest, ["minimiser", "edge"]).where(F.col("doc_id") > F.col("source.doc_id"))
              .select("doc_id", "text_key", F.explode("words_at").alias("word"), F.lit(k).cast("int").alias("words"),
                      F.col("source.doc_id").alias("source_doc"), F.col("source.text_key").alias("source_key"), F.col("source.word").alias("source_word")))
    return verified(docs, written(whole.unionByName(single), "op1-claims"))


def remove_repeats(docs: DataFrame, k: int = K, minimiser: int = MINIMISER) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one blank)."""
    spans = written(repeated_spans(docs, k, minimiser), "op1-spans")
    mine = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("word", "words")).alias("spans"))
    mine = mine.select(F.col("doc_id").alias("s_doc"), F.col("text_key").alias("s_key"), "spans")
    d = _keyed(docs)
    d = d.join(mine, (d["doc_id"] == F.col("s_doc")) & (d["text_key"] == F.col("s_key")), "left")
    return bound_arrow(d.select("doc_id", "text", "spans")).mapInArrow(
        _keep, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = """
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
g as (select doc_id, unnest(range(1, len(w) - 48)) as p, w from d where len(w) >= 50),
h as (select doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) as e from g),
f as (select e, min(doc_id) as low from h group by e),
r as (select h.doc_id, list(p) as ps from h join f using (e) where h.doc_id > f.low group by h.doc_id),
c as (select doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 50)))) as gone from r),
k as (select d.doc_id, len(d.w) as n, coalesce(len(c.gone), 0) as m,
      case when c.gone is null then d.w else list_transform(list_filter(range(1, len(d.w) + 1), lambda i: not list_contains(c.gone, i)), lambda i: d.w[i]) end as kept
      from d left join c using (doc_id))
select doc_id, n :: bigint as n_words, m :: bigint as n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k
"""

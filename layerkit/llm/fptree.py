"""Ranked lexical search with a document FP-tree.

Items are searched in blocks of bounded size (about ``BLOCK_TERMS`` terms; every item is in one block, all
documents are searched for each block). Per block:

1. Vectors: each whole text is reduced to its number of terms and its term frequencies restricted to the
   terms of the block. The table is written; N, L and every df come from it by aggregation.
2. Trees: the terms are ordered by falling df. Each task sorts the vectors of up to ``TREE_DOCS`` documents
   (``TREE_ENTRIES`` entries), so that vectors with a common beginning share a path of the tree; nodes are
   the branchings and the single documents. A node has, for every term below it, the largest tf, and the
   smallest m of its documents.
3. Search: depth first, children with the best bound first. A node's bound for an item is the score of a
   document with these tf maxima and this m: scores rise with tf and fall with m, in whole numbers too. An item goes
   on below a node only if the bound can still enter its best ``top``; the bounds of the items that come
   along are taken together. The best lists live on over the trees of a task, so later trees are cut
   earlier. Each task gives at most ``top`` rows an item, merged in two steps by windows.

Defined results: a null or empty text has no terms, matches nothing and does not count in N; documents of
equal score come by ascending doc_id, null ids last; every row of ``docs`` is a document, repeated rows
too; equal items have equal results, each item row gets its own; an item without terms, or whose terms are
in no document, gives no row, and so do empty tables. Extra columns of either table play no part.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runs import lower_ascii, pieces
from .scratch import bound_arrow, written
from .words import ragged

TOP = 20
BLOCK_TERMS = 100_000               # terms of the items searched at once, with repeats
TREE_DOCS, TREE_ENTRIES = 4096, 1 << 20
MERGE = 64                          # buckets of the first merge of the tasks' best rows
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_OUTSIDE = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_VECTOR = "doc_id long, n long, terms array<int>, tfs array<long>"
_FOUND = "item int, doc_id long, score long"


def term_counts(text: str | None) -> Counter:
    out: Counter = Counter()
    for part in pieces(text or "", _OUTSIDE):
        out.update(_TERM.findall(lower_ascii(part)))
    return out


def vectors(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs restricted to the vocabulary; documents with a term only."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        for batch in batches:
            doc, n, terms, tfs = [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_py())
                if counts:
                    known = [(ids[t], c) for t, c in counts.items() if t in ids]
                    doc.append(d)
                    n.append(sum(counts.values()))
                    terms.append([t for t, _ in known])
                    tfs.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return bound_arrow(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(step, _VECTOR)


class Index:
    """What the items of a block ask: per term (by falling df) the items that hold it, with weight times repeats."""

    def __init__(self, items: list[Counter], vocabulary: dict[str, int], df: dict[int, int], total: int):
        order = sorted((t for t in vocabulary.values() if df.get(t)), key=lambda t: (-df[t], t))
        self.rank = np.full(len(vocabulary), -1, dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        asks: list[list[tuple[int, int]]] = [[] for _ in order]
        for i, counts in enumerate(items):
            for term, repeats in counts.items():
                t = vocabulary[term]
                if df.get(t):
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    asks[self.rank[t]].append((i, w * repeats))
        self.items = len(items)
        self.counts = np.array([len(a) for a in asks], dtype=np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.item = np.array([i for a in asks for i, _ in a], dtype=np.int64)
        self.weight = np.array([w for a in asks for _, w in a], dtype=np.int64)

    def bounds(self, terms: np.ndarray, tfs: np.ndarray, m: int) -> np.ndarray:
        """For every item the score of a document with these term frequencies and this m."""
        part = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m)
        counts = self.counts[terms]
        at = ragged(self.starts[terms], counts)
        out = np.zeros(self.items, dtype=np.int64)
        np.add.at(out, self.item[at], self.weight[at] * np.repeat(part, counts))
        return out


class Node:
    __slots__ = ("terms", "tfs", "m", "children", "doc")

    def __init__(self, terms, tfs, m, children, doc=None):
        self.terms, self.tfs, self.m, self.children, self.doc = terms, tfs, m, children, doc


def _joined(children: list[Node]) -> Node:
    """A branching: tf maxima and the smallest m of what lies below."""
    terms = np.concatenate([c.terms for c in children])
    tfs = np.concatenate([c.tfs for c in children])
    order = np.argsort(terms, kind="stable")
    terms, tfs = terms[order], tfs[order]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    return Node(terms[first], np.maximum.reduceat(tfs, first) if len(first) else tfs, min(c.m for c in children), children)


def build_tree(leaves: list[Node]) -> Node | None:
    """The trie of the leaves' term sequences without chains: sorted, neighbours share what their paths share."""
    if not leaves:
        return None
    keys = [x.terms.astype(">i4").tobytes() for x in leaves]
    order = sorted(range(len(leaves)), key=keys.__getitem__)
    stack: list[tuple[int, list[Node]]] = [(0, [])]        # (terms shared by the children, the children)
    before: Node | None = None
    for k in order:
        leaf = leaves[k]
        if before is not None:
            n = min(len(before.terms), len(leaf.terms))
            other = np.flatnonzero(before.terms[:n] != leaf.terms[:n])
            common, last = int(other[0]) if len(other) else n, before
            while stack[-1][0] > common:
                depth, children = stack.pop()
                children.append(last)
                last = _joined(children)
            if stack[-1][0] < common:
                stack.append((common, []))
            stack[-1][1].append(last)
        before = leaf
    last = before
    while stack:
        _, children = stack.pop()
        children.append(last)
        last = _joined(children) if len(children) > 1 else children[0]
    return last


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        self.floor = np.ones(items, dtype=np.int64)        # a lower score cannot enter

    def offer(self, item: int, score: int, doc: int | None) -> None:
        entry, heap = (score, doc is not None, -(doc or 0)), self.heaps[item]
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.top:
            self.floor[item] = heap[0][0]


def search(root: Node, index: Index, best: Best) -> int:
    """Branch and bound of all items over one tree; the number of nodes it looked at."""
    def visit(node: Node) -> None:
        bound = index.bounds(node.terms, node.tfs, node.m)
        alive = np.flatnonzero(bound >= best.floor)
        if len(alive):
            reached.append((node, alive, bound[alive]))

    looked, stack, reached = 0, [], []
    visit(root)
    while stack or reached:
        looked += len(reached)
        reached.sort(key=lambda x: int(x[2].max()))
        stack += reached
        reached = []
        node, items, bound = stack.pop()
        keep = bound >= best.floor[items]                  # the floors may have risen meanwhile
        if node.doc is not None:
            for i, score in zip(items[keep].tolist(), bound[keep].tolist()):
                best.offer(i, score, node.doc[0])
        elif keep.any():
            for c in node.children:
                visit(c)
    return looked


def _search_step(index, documents: int, length: int, top: int):
    def trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[list[Node]]:
        leaves, entries = [], 0
        for batch in batches:
            lists, tfs = batch.column(2), batch.column(3)
            offsets, terms, freq = lists.offsets.to_numpy(), lists.values.to_numpy(), tfs.values.to_numpy()
            shift = tfs.offsets.to_numpy() - offsets
            for k, (d, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                a, b = offsets[k], offsets[k + 1]
                t = rank[terms[a:b]]
                order = np.argsort(t)
                m = 75 + (25 * n * documents) // length
                leaves.append(Node(t[order], freq[a + shift[k]:b + shift[k]][order], m, (), (d,)))
                entries += int(b - a)
                if len(leaves) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    yield leaves
                    leaves, entries = [], 0
        yield leaves

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = index.value
        best = Best(idx.items, top)
        for leaves in trees(batches, idx.rank):
            root = build_tree(leaves)
            if root is not None:
                search(root, idx, best)
        rows = [(i, -neg if known else None, s) for i, heap in enumerate(best.heaps) for s, known, neg in heap]
        for k in range(0, len(rows), 50_000):
            item, doc, score = zip(*rows[k:k + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return step


def _best_rows(found: DataFrame, top: int) -> DataFrame:
    """item, doc_id, score, rank: two steps, so that the rows of all tasks never meet in one."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE)))
    part = part.withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("place") <= top)
    return (part.select("item", "doc_id", "score", F.row_number().over(Window.partitionBy("item").orderBy(*order)).alias("rank"))
            .where(F.col("rank") <= top))


def _search_block(docs: DataFrame, texts: list[tuple[str, str]], top: int) -> DataFrame | None:
    """(digest, doc_id, score, rank) of one block of item texts, given as (digest, text)."""
    spark = docs.sparkSession
    items = [term_counts(text) for _, text in texts]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*items)))}
    if not vocabulary:
        return None
    table = written(vectors(docs, vocabulary), "op12-vectors")
    documents, length = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    # at most a row for each term of the block
    df = dict(tuple(r) for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    index = spark.sparkContext.broadcast(Index(items, vocabulary, df, documents))
    hit = bound_arrow(table.where(F.size("terms") > 0))
    found = written(hit.mapInArrow(_search_step(index, documents, int(length), top), _FOUND), "op12-found")
    names = spark.createDataFrame([(k, d) for k, (d, _) in enumerate(texts)], "item int, digest string")
    return _best_rows(found, top).join(names, "item").select("digest", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: for every row of ``items`` its ``top`` best documents."""
    spark = docs.sparkSession
    named = items.select("item_id", "text", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("digest"))
    asked = written(named.where("text is not null").groupBy("digest").agg(F.first("text").alias("text"))
                    .withColumn("terms", F.regexp_count("text", F.lit(_TERM.pattern))).where("terms > 0"), "op12-items")
    total = asked.agg(F.sum("terms")).first()[0] or 0
    blocks = -(-int(total) // block_terms)
    out = spark.createDataFrame([], "digest string, rank int, doc_id long, score long")
    block = F.pmod(F.xxhash64("digest"), F.lit(max(1, blocks)))
    for k in range(blocks):
        texts = [(r["digest"], r["text"]) for r in asked.where(block == k).orderBy("digest").collect()]     # one block of the query set
        found = _search_block(docs, texts, top) if texts else None
        if found is not None:
            out = out.unionByName(found)
    return named.select("item_id", "digest").join(out, "digest").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), q as (
  select item_id, term, count(*) as repeats from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term
), tf as (select doc_id, term, count(*) as tf from t group by doc_id, term),
n as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
g as (select count(*) as docs, sum(n)::bigint as len from n),
w as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*) as df from tf where term in (select term from q) group by term), g
), m as (select doc_id, 100 - 25 + ((25 * n * docs) // len) as m from n, g),
s as (
  select q.item_id, tf.doc_id, sum(q.repeats * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m)))::bigint as score
  from q join w using (term) join tf using (term) join m using (doc_id) group by q.item_id, tf.doc_id
), r as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0
)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20
"""

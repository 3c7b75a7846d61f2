"""Near-duplicates: banded MinHash candidates, sequential Bayesian verification, exact verification.

A document's set holds its distinct 5-word shingles (A-Z lower-cased); documents with a Jaccard
similarity of at least 0.75 are linked, and components of links are groups of near-duplicates.

1. Equal sets are one class, represented by its smallest doc_id; only representatives go on.
2. A signature of ``BANDS * ROWS`` minima is cut into bands; representatives that agree in a band share
   a bucket.
3. Each member of a bucket is first compared with the bucket's smallest member only. A comparison
   looks at the signatures batch by batch: with m of n minima equal (uniform prior), the posterior
   probability of a similarity of at least the threshold is ``P(Bin(n + 1, t) <= m)``; the pair is
   pruned once it falls below ``MISS``. Survivors are verified on their full sets.
4. Links found so far give components. In buckets that still hold several components, members of
   different components are compared in blocks of at most ``BLOCK`` members inside a task, by the same
   sequential test and exact verification. Only confirmed links leave the task, so a group of copies is
   never expanded into its pairs, and no pair of a bucket is skipped unless it is already connected.

A link is lost with a probability below about 2e-5 at a similarity of exactly 0.75 (no common band) plus
``MISS`` per batch; it falls steeply above (1e-7 at 0.8). Sets are compared as 64-bit shingle hashes.

Defined results: fewer than five words make one shingle of the whole sequence; an empty or null text
has an empty set, is linked with nothing and is kept; rows that repeat a doc_id (or have none) give one
row each: with equal texts they share a class, with different ones the row's own text decides the class
and links are between doc_ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import bound_arrow, texts, written
from .words import mix, span_hashes, window_hashes, word_batches

SHINGLE, THRESHOLD = 5, 0.75
BANDS, ROWS = 40, 5
BATCH = 25              # minima looked at before each decision
MISS = 1e-6             # posterior probability below which a pair is given up
BLOCK = 512             # members of a bucket that a task holds on each side
_rng = np.random.default_rng(75)
_A = _rng.integers(1, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int = SHINGLE):
    """Sorted distinct shingle hashes of each row of a text column."""
    for w in word_batches(column, lower=True):
        grams = window_hashes(w.hashes, k)
        for lo, hi in zip(w.bounds[:-1], w.bounds[1:]):
            if hi - lo >= k:
                yield np.unique(grams[lo:hi - k + 1])
            elif hi > lo:
                yield span_hashes(w.hashes[lo:hi], np.array([0]), np.array([hi - lo]))
            else:
                yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per non-empty set."""
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sets):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + 65536, side="right")))
        values = np.concatenate(sets[i:j])
        at = np.concatenate(([0], np.cumsum(sizes[i:j])[:-1]))
        for h in range(BANDS * ROWS):
            out[i:j, h] = np.minimum.reduceat(values * _A[h] + _B[h], at) >> np.uint64(32)
        i = j
    return out


def least_matches(threshold: float = THRESHOLD, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(n, fewest equal minima among the first n that keep a pair alive)."""
    table = []
    for n in range(batch, BANDS * ROWS + 1, batch):
        total, m = 0.0, -1
        while total < miss and m <= n:       # P(Bin(n + 1, t) <= m)
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        table.append((n, m))
    return table


LEAST = least_matches()


def alive(left: np.ndarray, right: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of the pairs (row of left, row of right) survive the sequential test."""
    a, b = pairs
    live = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int32)
    done = 0
    for n, least in LEAST:
        matches[live] += (left[a[live], done:n] == right[b[live], done:n]).sum(axis=1, dtype=np.int32)
        live = live[matches[live] >= least]
        done = n
    return live


def similar(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Exact comparison of two sorted sets."""
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= round(100 * threshold) * (len(x) + len(y) - common)


def _describe(batches):
    for batch in batches:
        sets = list(shingle_sets(batch.column("text")))
        full = [i for i, s in enumerate(sets) if len(s)]
        sig = signatures([sets[i] for i in full]) if full else None
        rows: list[bytes | None] = [None] * len(sets)
        for r, i in enumerate(full):
            rows[i] = sig[r].tobytes()
        yield pa.record_batch([
            batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array(rows, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_key", "signature"])


def _buckets(batches):
    for batch in batches:
        n = batch.num_rows
        sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint32).reshape(n, BANDS * ROWS)
        key = np.empty((n, BANDS), dtype=np.uint64)
        for band in range(BANDS):
            x = np.full(n, (band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
            for r in range(ROWS):
                x = mix(x ^ sig[:, band * ROWS + r].astype(np.uint64))
            key[:, band] = x
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids, BANDS))], names=["bucket", "id"])


def _prune(batches):
    for batch in batches:
        sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, BANDS * ROWS)
                 for c in ("sig_a", "sig_b")]
        every = np.arange(batch.num_rows)
        keep = pa.array(alive(*sides, (every, every)))
        yield pa.record_batch([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])


def _confirm(batches):
    for batch in batches:
        keep = [i for i, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()))
                if similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))]
        yield pa.record_batch([batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))],
                              names=["a", "b"])


def _compare_blocks(batches):
    """Rows come sorted by (bucket, left, right): the members of two blocks of one bucket."""
    held, key = [], None

    def links():
        if len(held) < 2:
            return []
        ids = np.array([r["id"] for r in held])
        comp = np.array([r["component"] for r in held])
        block = np.array([r["block"] for r in held])
        sig = np.frombuffer(b"".join(r["signature"] for r in held), dtype=np.uint32).reshape(len(held), -1)
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in held]
        left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
        found, parent = [], {c: c for c in comp.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        for i in left:      # one member against a block: memory stays in proportion to the block
            others = right[(comp[right] != comp[i]) & ((right > i) if key[1] == key[2] else True)]
            if not len(others):
                continue
            live = others[alive(sig, sig, (np.full(len(others), i), others))]
            for j in live:
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a != b and similar(sets[i], sets[j]):
                    parent[max(a, b)] = min(a, b)
                    found.append((int(ids[i]), int(ids[j])))
        return found

    def emit(found):
        return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                               names=["a", "b"])

    for batch in batches:
        for row in batch.to_pylist():
            now = (row["bucket"], row["left"], row["right"])
            if now != key:
                if found := links():
                    yield emit(found)
                held, key = [], now
            held.append(row)
    if found := links():
        yield emit(found)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (16 bytes, null for an empty set) and signature."""
    return bound_arrow(texts(docs).withColumn("text_key", F.xxhash64("text"))).mapInArrow(
        _describe, "doc_id long, text_key long, n_shingles long, set_key binary, signature binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key (fingerprint of the text)."""
    described = written(describe(docs), "op8-signatures")
    classes = (described.where("set_key is not null and doc_id is not null").groupBy("n_shingles", "set_key")
               .agg(F.min("doc_id").alias("id")))
    classes = written(classes, "op8-classes")
    # a doc_id that repeats with other texts may stand for several classes; its links are the same vertex
    reps = (described.join(classes.select("set_key", "id"), "set_key").where("doc_id = id")
            .select("id", "signature").dropDuplicates(["id", "signature"]))
    buckets = written(bound_arrow(reps).mapInArrow(_buckets, "bucket long, id long"), "op8-buckets")
    shared = (buckets.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("members"))
              .where("first < last"))
    members = written(buckets.join(shared.drop("last"), "bucket"), "op8-members")

    # signatures and full sets of the members, from the texts again
    wanted = members.select("id").distinct()
    payload = (texts(docs).join(wanted, F.col("doc_id") == F.col("id")).drop("doc_id")
               .select("id", "text").dropDuplicates(["id", "text"]))
    payload = written(bound_arrow(payload).mapInArrow(_payload, "id long, signature binary, shingles binary"), "op8-payload")

    pairs = members.where("id > first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = written(verify(pairs, payload), "op8-links")
    component = components(links)

    placed = (members.join(component, F.col("id") == F.col("vertex"), "left")
              .select("bucket", "id", "first", "members", F.coalesce("component", "id").alias("component")))
    placed = written(placed, "op8-placed")
    # the first member has met all others: only the rest can hold unmet members of several components
    mixed = (placed.where("id <> first").groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("bucket"))
    more = compare_in_blocks(placed.where("id <> first").join(mixed, "bucket"), payload)
    final = components(links.unionByName(written(more, "op8-more")))

    member_of = (described.join(classes.select("set_key", "id"), "set_key", "left")
                 .join(final, F.col("id") == F.col("vertex"), "left"))
    component_id = F.coalesce("component", "id", "doc_id")
    return member_of.select("doc_id", "n_shingles", component_id.alias("component_id"),
                            F.col("doc_id").eqNullSafe(component_id).alias("kept"), "text_key")


def _payload(batches):
    for batch in batches:
        sets = list(shingle_sets(batch.column("text")))
        keep = [i for i, s in enumerate(sets) if len(s)]
        if not keep:
            continue
        sig = signatures([sets[i] for i in keep])
        yield pa.record_batch([batch.column("id").take(pa.array(keep)), pa.array([s.tobytes() for s in sig], pa.binary()),
                               pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["id", "signature", "shingles"])


def verify(pairs: DataFrame, payload: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the sequential test and the exact comparison."""
    sig = payload.select("id", "signature")
    both = (pairs.join(sig.select(F.col("id").alias("a"), F.col("signature").alias("sig_a")), "a")
            .join(sig.select(F.col("id").alias("b"), F.col("signature").alias("sig_b")), "b"))
    survivors = bound_arrow(both).mapInArrow(_prune, "a long, b long").distinct()
    sets = payload.select("id", "shingles")
    full = (survivors.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b"))
    return bound_arrow(full).mapInArrow(_confirm, "a long, b long").distinct()


def compare_in_blocks(members: DataFrame, payload: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links between members (bucket, id, members, component) of different components of a bucket."""
    blocks = F.ceil(F.col("members") / F.lit(block))
    own = members.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).withColumn("blocks", blocks)
    met = (own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .select("bucket", "id", "component", "block", F.least("block", "other").alias("left"),
                   F.greatest("block", "other").alias("right")))
    rows = met.join(payload, "id")
    grouped = rows.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right", "component", "id")
    return bound_arrow(grouped).mapInArrow(_compare_blocks, "a long, b long").distinct()


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one document of each group. A row is judged by its
    doc_id and its text."""
    dropped = (near_duplicates(docs).where("not kept")
               .select(F.col("doc_id").alias("__dropped"), F.col("text_key").alias("__key")).distinct())
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["__dropped"]) & (key == dropped["__key"]), "left_anti")


ORACLE = """
with recursive d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
s as (select doc_id, unnest(case when len(w) >= 5
        then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] :: varchar[] end) as g from d),
n as (select d.doc_id, count(s.g) as n from d left join s using (doc_id) group by d.doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as common from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * common >= 75 * (nx.n + ny.n - common)),
both_ways as (select x, y from e union all select y, x from e),
reach(doc_id, c) as (select doc_id, doc_id from d union select b.y, r.c from reach r join both_ways b on b.x = r.doc_id where r.c < b.y),
m as (select doc_id, min(c) as component_id from reach group by doc_id)
select n.doc_id, n.n as n_shingles, m.component_id, n.doc_id = m.component_id as kept from n join m using (doc_id)
"""

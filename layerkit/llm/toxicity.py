"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has the probability ``p = sigmoid(bias + sum of the weights of
its features)``; its words, and the first four and five bytes of its words, are features, hashed into
``BUCKETS``. The document is toxic when any sentence is: ``P = 1 - product(1 - p)`` (noisy-or). Only documents
are labelled; the gradient of the document's likelihood shares a toxic label among the sentences by their
own probability, so training also finds which sentences offend (:func:`offending_sentences`).

Labels are learned from rows whose ``crc32(doc_id) mod 5`` is not 0. Training uses a sample of at most
``SAMPLE`` documents of each label, in order of a hash of the doc_id, each text of a doc_id once. The sample is written
and stays in Spark: in each step the weights go to ``PARTS`` tasks, each returns the loss and the gradient of its part (at
most 8 * ``BUCKETS`` bytes), and the driver adds them up. Nothing of a text, and nothing whose size grows with the texts, comes
to the driver. The fit is a quasi-Newton descent over non-negative weights (:func:`minimise`). Scoring covers every whole text.

Sentences end at ``. ! ?``, at a line break, or after ``LONGEST`` words.

Defined results: a null or empty text has no sentence and scores 0; a doc_id with several labels is toxic
when one of them is; without labels of both kinds the score is 0 for every document; rows that repeat a doc_id
are scored each by its own text, and a null doc_id is never learned from and not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import bound_arrow, texts, written
from .words import hash_spans, word_spans, pieces

BUCKETS = 1 << 18
SAMPLE = 3000            # labelled documents of each label used for training, at most
LONGEST = 40
LEAST_DOCUMENTS = 5      # a feature of fewer sampled documents gets no weight
STEPS, MEMORY, SPARSITY, BIAS = 30, 8, 3e-4, -6.0
PARTS = 12               # tasks that share the sample
CLEAN_SHARE = 0.8        # weight of all clean documents together
_END = np.zeros(256, dtype=bool)
_END[list(b".!?")] = True
_TRIM = np.zeros(256, dtype=bool)
_TRIM[list(b".,!?;:\"'()")] = True


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(features per word [n, 3], sentence of each word, row of each sentence, first byte, end byte) of a piece."""
    starts, ends = word_spans(data, offsets)
    n = len(starts)
    bounds = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros((0, 3), np.int32), none, none, none, none
    breaks = np.concatenate(([0], np.cumsum(data == 0x0A)))
    cut = np.ones(n, dtype=bool)
    cut[1:] = _END[data[ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1]]) | (row[1:] != row[:-1])
    first = np.flatnonzero(cut)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    cut |= place % LONGEST == 0
    sentence = np.cumsum(cut) - 1
    first = np.flatnonzero(cut)
    last = np.append(first[1:], n) - 1
    a, b = starts.copy(), ends.copy()
    for _ in range(2):                    # quotes and marks around a word
        b -= _TRIM[data[b - 1]] & (b - a > 1)
        a += _TRIM[data[a]] & (b - a > 1)
    mask, kind = np.uint64(BUCKETS - 1), np.uint64(0x5851F42D4C957F2D)
    whole = hash_spans(data, a, b, lower=True)
    four = hash_spans(data, a, np.minimum(a + 4, b), lower=True) * kind
    five = hash_spans(data, a, np.minimum(a + 5, b), lower=True) * (kind + np.uint64(2))
    features = np.stack([(h >> np.uint64(40)) & mask for h in (whole, four, five)], axis=1).astype(np.int32)
    return features, sentence, row[first], starts[first], ends[last]


def _features(batches):
    for batch in batches:
        for first, data, offsets in pieces(batch.column("text")):
            features, sentence, row, _, _ = sentences(data, offsets)
            n = len(offsets) - 1
            words = np.concatenate(([0], np.cumsum(np.bincount(row[sentence], minlength=n)))) if len(sentence) else np.zeros(n + 1, int)
            yield pa.record_batch(
                [batch.column(c).slice(first, n) for c in ("doc_id", "toxic")]
                + [pa.array([features[a:b].tobytes() for a, b in zip(words[:-1], words[1:])], pa.binary()),
                   pa.array([(sentence[a:b] - (sentence[a] if b > a else 0)).astype(np.int32).tobytes()
                             for a, b in zip(words[:-1], words[1:])], pa.binary())],
                names=["doc_id", "toxic", "features", "sentences"])


def _spread(batches):
    """Documents, and toxic documents, of each feature, summed over the batches of a task."""
    spread = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for f, toxic in zip(batch.column("features"), batch.column("toxic").to_pylist()):
            spread[int(toxic == 1), np.unique(np.frombuffer(f.as_buffer(), np.int32))] += 1
    used = np.flatnonzero(spread.any(axis=0))
    yield pa.record_batch([pa.array(used), pa.array(spread.sum(axis=0)[used]), pa.array(spread[1][used])], names=["feature", "documents", "toxic"])


def _telling(used: np.ndarray):
    """Bags without the words that have no used feature; features become their places in ``used``."""
    def run(batches):
        place = np.full(BUCKETS, len(used), dtype=np.int32)        # the others share a place that stays 0
        place[used] = np.arange(len(used))
        for batch in batches:
            columns = [[], [], []]
            for f, t in zip(batch.column("features"), batch.column("sentences")):
                local = place[np.frombuffer(f.as_buffer(), np.int32).reshape(-1, 3)]
                sentence = np.frombuffer(t.as_buffer(), np.int32)
                keep = (local < len(used)).any(axis=1)
                for c, v in zip(columns, (int(sentence[-1]) + 1, local[keep].tobytes(), sentence[keep].tobytes())):
                    c.append(v)
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array(columns[0], pa.int32())]
                                  + [pa.array(c, pa.binary()) for c in columns[1:]],
                                  names=["doc_id", "toxic", "n_sentences", "features", "sentences"])
    return run


def loss_and_gradient(w: np.ndarray, labels: np.ndarray, share: np.ndarray, bag: np.ndarray, sentence: np.ndarray, places: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of noisy-or bags and its gradient.

    labels, share: per bag; bag: of each sentence; sentence, places [words, 3]: of each word. ``w`` holds a weight
    for each place, an unused one (features without a weight) and the bias."""
    z = np.full(len(bag), w[-1])
    for j in range(3):
        z += np.bincount(sentence, weights=w[places[:, j]], minlength=len(bag))
    z = np.clip(z, -30, 30)
    none = np.bincount(bag, weights=np.logaddexp(0, z), minlength=len(labels))       # -log of "no sentence"
    any_ = np.maximum(-np.expm1(-none), 1e-12)
    loss = float((share * np.where(labels == 1, -np.log(any_), none)).sum())
    # d loss / d z: p for clean documents, -p (1 - P) / P for toxic ones
    slope = share * np.where(labels == 1, -np.exp(-none) / any_, 1.0)
    g = slope[bag] / (1 + np.exp(-z))
    gradient = np.zeros_like(w)
    for j in range(3):
        gradient[:-1] += np.bincount(places[:, j], weights=g[sentence], minlength=len(w) - 1)
    gradient[-1] = g.sum()
    gradient[-2] = 0.0
    return loss, gradient


def minimise(evaluate, w: np.ndarray, steps: int = STEPS, memory: int = MEMORY) -> np.ndarray:
    """Quasi-Newton descent (limited memory) on ``evaluate(w)`` plus ``SPARSITY`` times the sum of the weights,
    which are never negative; the last one, the bias, is free and not penalised.

    Weights at 0 that the gradient would make negative are left out of a step; a step is cut back to the
    non-negative weights and halved until the loss falls enough."""
    def full(w):
        loss, gradient = evaluate(w)
        gradient[:-2] += SPARSITY
        return loss + SPARSITY * w[:-2].sum(), gradient

    value, gradient = full(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        free = (w > 0) | (gradient < 0)
        free[-1], free[-2] = True, False
        slope = np.where(free, gradient, 0.0)
        step, parts = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ step) / (s @ y)
            step -= a * y
            parts.append(a)
        step *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 0.5 / max(np.abs(slope).max(), 1e-12)
        for (s, y), a in zip(pairs, reversed(parts)):
            step += s * (a - (y @ step) / (s @ y))
        step = np.where(free & (step * slope > 0), step, 0.0)
        if not step.any():
            pairs = []
            step = slope * (0.5 / max(np.abs(slope).max(), 1e-12))
        length, moved = 1.0, False
        for _ in range(6):
            new = w - length * step
            new[:-1] = np.maximum(new[:-1], 0.0)
            there, slope_there = full(new)
            if there <= value + 1e-4 * (gradient @ (new - w)):
                moved = True
                break
            length /= 2
        if not moved:
            break
        s, y = new - w, slope_there - gradient
        if s @ y > 1e-12:
            pairs = (pairs + [(s, y)])[-memory:]
        done = value - there < 1e-3 * value
        w, value, gradient = new, there, slope_there
        if done:
            break
    return w


def _gradient_step(shared, size: int):
    """Loss and gradient of the rows of a task, batch by batch."""
    def run(batches):
        w, share_of = shared.value
        loss, gradient = 0.0, np.zeros(size)
        for batch in batches:
            labels = np.array(batch.column("toxic"))
            counts = np.array(batch.column("n_sentences"))
            base = np.cumsum(counts) - counts
            places = [np.frombuffer(f.as_buffer(), np.int32).reshape(-1, 3) for f in batch.column("features")]
            sentence = [np.frombuffer(t.as_buffer(), np.int32) + b for t, b in zip(batch.column("sentences"), base)]
            if len(labels):
                part, g = loss_and_gradient(w, labels, np.where(labels == 1, share_of[1], share_of[0]), np.repeat(np.arange(len(labels)), counts),
                                            np.concatenate(sentence), np.concatenate(places))
                loss, gradient = loss + part, gradient + g
        yield pa.record_batch([pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], names=["loss", "gradient"])
    return run


def evaluator(bags: DataFrame, size: int, share_of: tuple[float, float]):
    """``evaluate(w)`` over written bags: the sums of what the tasks return (a bounded number of bounded rows)."""
    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray]:
        shared = bags.sparkSession.sparkContext.broadcast((w, share_of))
        try:
            rows = bags.mapInArrow(_gradient_step(shared, size), "loss double, gradient binary").collect()
        finally:
            shared.unpersist()
        rows.sort(key=lambda r: r["loss"])                    # the same sum whatever task comes first
        gradient = np.zeros(size)
        for r in rows:
            gradient += np.frombuffer(r["gradient"])
        return sum(r["loss"] for r in rows), gradient
    return evaluate


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights (the last one is the bias) learned from a bounded sample of the labelled rows that are not held out.

    Weights of features are evidence: they are never negative, and a penalty on their sum keeps all but the
    telling ones at 0. A feature that no toxic document has would stay at 0, so it is left out."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = (F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    chosen = known.where("toxic = 1").orderBy(*order).limit(sample).unionByName(known.where("toxic = 0").orderBy(*order).limit(sample))
    chosen = chosen.select(F.col("doc_id").alias("label_id"), "toxic")
    bags = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "toxic", "text")
    bags = bags.dropDuplicates(["doc_id", "text"])            # repeated rows are learned from once
    bags = written(bound_arrow(bags).mapInArrow(_features, "doc_id long, toxic int, features binary, sentences binary")
                   .where(F.octet_length("sentences") > 0), "op7-sample")
    spread = bags.select("toxic", "features").mapInArrow(_spread, "feature long, documents long, toxic long").groupBy("feature")
    often = spread.agg(F.sum("documents").alias("documents"), F.sum("toxic").alias("toxic")).where((F.col("documents") >= LEAST_DOCUMENTS) & (F.col("toxic") > 0))
    used = np.sort(np.array([r["feature"] for r in often.select("feature").collect()], dtype=np.int64))      # at most BUCKETS
    told = bags.repartition(PARTS, "doc_id").sortWithinPartitions("doc_id", "features")
    told = written(told.mapInArrow(_telling(used), "doc_id long, toxic int, n_sentences int, features binary, sentences binary"), "op7-bags")
    count = {r["toxic"]: r["count"] for r in told.groupBy("toxic").count().collect()}
    weights = np.zeros(BUCKETS + 1, dtype=np.float64)
    if set(count) != {0, 1}:
        weights[-1] = -np.inf
        return weights
    w = np.zeros(len(used) + 2)
    w[-1] = BIAS
    w = minimise(evaluator(told, len(w), (CLEAN_SHARE / count[0], (1 - CLEAN_SHARE) / count[1])), w)
    weights[used], weights[-1] = w[:-2], w[-1]
    return weights


def _sentence_scores(data, offsets, weights):
    features, sentence, row, first, end = sentences(data, offsets)
    if not len(sentence) or weights[-1] == -np.inf:
        return row, first, end, np.zeros(len(row))
    z = np.bincount(sentence, weights=weights[features].sum(axis=1), minlength=len(row)) + weights[-1]
    return row, first, end, np.clip(z, -30, 30)


def _score(weights: np.ndarray):
    def run(batches):
        for batch in batches:
            for at, data, offsets in pieces(batch.column("text")):
                n = len(offsets) - 1
                row, _, _, z = _sentence_scores(data, offsets, weights)
                none = np.bincount(row, weights=np.logaddexp(0, z), minlength=n) if len(row) and weights[-1] != -np.inf else np.zeros(n)
                score = -np.expm1(-none)
                yield pa.record_batch([batch.column("doc_id").slice(at, n), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                      names=["doc_id", "score", "predicted"])
    return run


def _offending(weights: np.ndarray, least: float):
    def run(batches):
        for batch in batches:
            for at, data, offsets in pieces(batch.column("text")):
                row, first, end, z = _sentence_scores(data, offsets, weights)
                p = 1 / (1 + np.exp(-z)) if weights[-1] != -np.inf else np.zeros(len(z))
                hit = np.flatnonzero(p >= least)
                raw = data.tobytes()
                yield pa.record_batch([batch.column("doc_id").take(pa.array(row[hit] + at)), pa.array(p[hit]),
                                       pa.array([raw[first[i]:end[i]].decode("utf-8") for i in hit], pa.string())],
                                      names=["doc_id", "score", "sentence"])
    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = bound_arrow(texts(docs)).mapInArrow(_score(weights), "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def offending_sentences(docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """doc_id, score and text of the sentences that score at least ``least``."""
    return bound_arrow(texts(docs)).mapInArrow(_offending(weights, least), "doc_id long, score double, sentence string")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))


def _pass(weights: np.ndarray):
    def run(batches):
        for batch in batches:
            keep = []
            for at, data, offsets in pieces(batch.column("text")):
                n = len(offsets) - 1
                row, _, _, z = _sentence_scores(data, offsets, weights)
                none = np.bincount(row, weights=np.logaddexp(0, z), minlength=n) if len(row) and weights[-1] != -np.inf else np.zeros(n)
                keep.append(-np.expm1(-none) < 0.5)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))
    return run


def remove_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic, judged where they are read."""
    return bound_arrow(docs).mapInArrow(_pass(train(docs, labels, **options)), docs.schema)

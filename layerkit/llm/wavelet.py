"""Token ids in wavelet-matrix shards.

A shard file holds the ids of consecutive documents. Bit by bit, from the highest, the ids are written as a
plane of bits and then stably parted by that bit; with the number of ones before every block of 512 bits
each plane answers rank and select. So one file gives access to any token, counts a token in any range
and finds its occurrences without being unpacked, at 16 bits a token for a vocabulary below 65,536.

Documents are range-partitioned and sorted by doc_id (null first), so shards follow one another; a task
writes a shard of about ``SHARD_TOKENS`` tokens at a time. Spark writes the files (one per shard, through its
commit protocol, to any file system it knows) and reads them back as binary files.

File: magic, header (levels, documents, tokens, partition, shard), doc_ids with a null flag each, tokens per
document, then per plane the number of zeros, the block counts and the bits; integers little-endian; closed
by a mark.

Defined results: a null or empty text is a document of the end id alone; rows that repeat a doc_id follow
one another (ordered by text); an empty table writes no shard and gives no rows. A document is never split,
so one very long document makes a longer shard.
"""

from __future__ import annotations

import contextlib
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import default_vocabulary
from .scratch import bound_arrow, texts, written
from .wordids import ID_PIECE, WordIds, text_ids
from .words import pieces, process_cache, ragged

MAGIC, CLOSING = b"WMTOKEN1", "WMTOKEN1END"
HEADER = "<8sIIQII"
END_ID = 1
SHARD_TOKENS = 1 << 22
BLOCK = 512


class WaveletMatrix:
    """Bit planes with rank and select over a sequence of non-negative integers."""

    def __init__(self, n: int, levels: int, zeros: list[int], blocks: list[np.ndarray], planes: list[np.ndarray]):
        self.n, self.levels, self.zeros, self.blocks, self.planes = n, levels, zeros, blocks, planes

    @classmethod
    def build(cls, values: np.ndarray, levels: int) -> WaveletMatrix:
        now = values.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, blocks, planes = [], [], []
        for level in range(levels - 1, -1, -1):
            bits = (now >> now.dtype.type(level)) & now.dtype.type(1)
            ones = bits.astype(bool)
            packed = np.packbits(ones, bitorder="little")
            padded = np.zeros(-(-len(now) // BLOCK) * (BLOCK // 8), dtype=np.uint8)
            padded[:len(packed)] = packed
            counts = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            blocks.append(np.concatenate((np.zeros(1, np.uint32), np.cumsum(counts, dtype=np.uint32))))
            planes.append(padded)
            zeros.append(len(now) - int(blocks[-1][-1]))
            now = np.concatenate((now[~ones], now[ones]))
        return cls(len(values), levels, zeros, blocks, planes)

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place: a block count plus the bits of the block up to the place."""
        block = at // BLOCK
        words = self.planes[level].view(np.uint64).reshape(-1, BLOCK // 64)
        inside = at - block * BLOCK
        full = np.minimum(block, len(words) - 1)
        low = np.clip(inside[:, None] - np.arange(0, BLOCK, 64)[None, :], 0, 64)
        masks = np.where(low == 64, ~np.uint64(0), (np.uint64(1) << (low % 64).astype(np.uint64)) - np.uint64(1))
        return self.blocks[level][block].astype(np.int64) + np.bitwise_count(words[full] & masks).sum(axis=1, dtype=np.int64)

    def access(self, at) -> np.ndarray:
        at = np.atleast_1d(np.asarray(at, dtype=np.int64))
        out = np.zeros(len(at), dtype=np.uint32)
        for level in range(self.levels):
            bit, ones = self._bit(level, at), self._ones(level, at)
            out = out << np.uint32(1) | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return out

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a value in [start, stop)."""
        lo, hi = self._range(value, start, self.n if stop is None else stop)
        return hi - lo

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.levels):
            if lo >= hi or value >> self.levels:
                return 0, 0
            a, b = (int(x) for x in self._ones(level, np.array([lo, hi])))
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if value >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit: binary search in the block counts, then in the block."""
        counts = self.blocks[level].astype(np.int64)
        if not bit:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(counts, k, side="right")) - 1
        raw = self.planes[level][block * (BLOCK // 8):(block + 1) * (BLOCK // 8)]
        bits = np.unpackbits(raw, bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(counts[block])])

    def occurrences(self, value: int, start: int = 0, stop: int | None = None) -> list[int]:
        """Places of a value in [start, stop), in order."""
        lo, hi = self._range(value, start, self.n if stop is None else stop)
        out = []
        for at in range(lo, hi):
            for level in range(self.levels - 1, -1, -1):
                bit = value >> (self.levels - 1 - level) & 1
                at = self._select(level, bit, at - self.zeros[level] if bit else at)
            out.append(at)
        return out

    def values(self) -> np.ndarray:
        """The whole sequence: the parting of each plane is undone from the last plane up."""
        out = np.zeros(self.n, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            # what stood at i went to the zeros in front or the ones behind
            back = np.empty(self.n, dtype=out.dtype)
            back[~ones] = out[:self.zeros[level]]
            back[ones] = out[self.zeros[level]:] | out.dtype.type(1 << (self.levels - 1 - level))
            out = back
        return out


def write_shard(doc_ids: list, counts: np.ndarray, ids: np.ndarray, partition: int, shard: int) -> bytes:
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    m = WaveletMatrix.build(ids, levels)
    parts = [struct.pack(HEADER, MAGIC, levels, len(doc_ids), m.n, partition, shard),
             np.array([x if x is not None else 0 for x in doc_ids], dtype="<i8").tobytes(),
             np.array([x is None for x in doc_ids], dtype=np.uint8).tobytes(), counts.astype("<u8").tobytes()]
    for zeros, blocks, plane in zip(m.zeros, m.blocks, m.planes):
        parts += [struct.pack("<Q", zeros), blocks.astype("<u4").tobytes(), plane.tobytes()]
    return b"".join(parts)


def read_shard(raw: bytes) -> tuple[tuple[int, int], list, np.ndarray, WaveletMatrix]:
    """((partition, shard), doc_ids, tokens per document, wavelet matrix) of a file's bytes."""
    magic, levels, docs, n, partition, shard = struct.unpack_from(HEADER, raw)
    if magic != MAGIC or not raw.endswith(CLOSING.encode()):
        raise ValueError("not a whole token shard")
    at = struct.calcsize(HEADER)

    def take(dtype, count):
        nonlocal at
        out = np.frombuffer(raw, dtype=dtype, count=count, offset=at)
        at += out.nbytes
        return out

    ids, null, counts = take("<i8", docs), take(np.uint8, docs), take("<u8", docs).astype(np.int64)
    n_blocks = -(-n // BLOCK)
    zeros, blocks, planes = [], [], []
    for _ in range(levels):
        zeros.append(int(take("<u8", 1)[0]))
        blocks.append(take("<u4", n_blocks + 1))
        planes.append(np.frombuffer(take(np.uint8, n_blocks * (BLOCK // 8)).tobytes(), np.uint8))
    doc_ids = [None if gone else int(i) for i, gone in zip(ids, null)]
    return (partition, shard), doc_ids, counts, WaveletMatrix(n, levels, zeros, blocks, planes)


def library_words(path: str) -> WordIds:
    """Word ids by the tokenizers library: new words are encoded together, parted by a mark that none of
    them holds."""
    held = process_cache()
    if ("library", path) not in held:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs a task per core
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        t.encode_special_tokens = False
        parting = "\x7f"                # one token; words that hold it are encoded alone
        parting_id, = t.encode(parting, add_special_tokens=False).ids

        def encode_words(words: list[str]):
            out: list = [None] * len(words)
            plain = [i for i, w in enumerate(words) if parting not in w]
            for i, w in enumerate(words):
                if parting in w:
                    out[i] = np.array(t.encode(w, add_special_tokens=False).ids, dtype=np.uint32)
            groups = [plain[k:k + 500] for k in range(0, len(plain), 500)]
            for some, e in zip(groups, t.encode_batch_fast([f" {parting} ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)):
                ids = np.array(e.ids, dtype=np.uint32)
                cuts = np.flatnonzero(ids == parting_id).tolist()
                for i, a, b in zip(some, [0, *[c + 1 for c in cuts]], [*cuts, len(ids)]):
                    out[i] = ids[a:b]
            return out

        held["library", path] = WordIds(encode_words)
    return held["library", path]


def _shards(path: str, shard_tokens: int, end_id: int):
    def run(batches):
        cache = library_words(path)
        partition, shard = TaskContext.get().partitionId(), 0
        doc_ids, counts, held, size = [], [], [], 0

        def close():
            nonlocal doc_ids, counts, held, size, shard
            raw = write_shard(doc_ids, np.array(counts, dtype=np.int64), np.concatenate(held), partition, shard)
            doc_ids, counts, held, size, shard = [], [], [], 0, shard + 1
            return pa.record_batch([pa.array([raw], pa.binary())], names=["shard"])

        for batch in batches:
            for first, data, offsets in pieces(batch.column("text"), ID_PIECE):
                ids, bounds = text_ids(cache, data, offsets)
                n = len(bounds) - 1
                out = np.full(len(ids) + n, end_id, dtype=np.uint32)
                keep = np.ones(len(out), dtype=bool)
                keep[bounds[1:] + np.arange(n)] = False
                out[keep] = ids
                doc_ids += batch.column("doc_id").slice(first, n).to_pylist()
                counts += (np.diff(bounds) + 1).tolist()
                held.append(out)
                size += len(out)
                if size >= shard_tokens:
                    yield close()
        if doc_ids:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS,
                 end_id: int = END_ID, partitions: int | None = None) -> None:
    """Encodes every text, appends the end id and writes shards in ascending doc_id order to ``path``."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts(docs).repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    shards = bound_arrow(ordered).mapInArrow(_shards(vocabulary or default_vocabulary(), shard_tokens, end_id), "shard binary")
    # the text writer puts the bytes of a row into a file as they are, and the closing mark after them
    shards.select(F.col("shard").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", CLOSING).text(path)


def _documents(batches):
    for batch in batches:
        for raw in batch.column("content"):
            (partition, shard), doc_ids, counts, matrix = read_shard(raw.as_py())
            ids = matrix.values().astype("<u4")
            ends = np.cumsum(counts)
            yield pa.record_batch(
                [pa.array([partition] * len(counts), pa.int64()), pa.array([shard] * len(counts), pa.int64()),
                 pa.array(doc_ids, pa.int64()), pa.array(ends - counts), pa.array(counts),
                 pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - counts, ends)], pa.int64())],
                names=["partition", "shard", "doc_id", "within", "n_tokens", "ids_crc32"])


@contextlib.contextmanager
def shard_by_shard(spark: SparkSession):
    """One file an Arrow batch for the jobs run inside; the caller's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the shard files: doc_id, start, n_tokens, ids_crc32."""
    files = _files(spark, path)
    with shard_by_shard(spark):
        docs = written(files.mapInArrow(
            _documents, "partition long, shard long, doc_id long, within long, n_tokens long, ids_crc32 long"), "op6-read")
    # ids before a shard: partitions first, then the shards of a partition
    shards = docs.groupBy("partition", "shard").agg(F.sum("n_tokens").alias("n"))
    whole = shards.groupBy("partition").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = whole.select("partition", earlier(Window.orderBy("partition")).alias("before_partition"))
    shards = (shards.withColumn("before_shard", earlier(Window.partitionBy("partition").orderBy("shard"))).join(whole, "partition")
              .select("partition", "shard", (F.col("before_partition") + F.col("before_shard")).alias("before")))
    return docs.join(shards, ["partition", "shard"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("content")


def _counts(tokens: list[int]):
    def run(batches):
        for batch in batches:
            for raw in batch.column("content"):
                _, _, _, matrix = read_shard(raw.as_py())
                yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())], names=["token", "n"])
    return run


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, n: how often each given id occurs in the shards; by rank, no sequence is unpacked."""
    tokens = sorted(set(tokens))
    with shard_by_shard(spark):
        found = written(_files(spark, path).mapInArrow(_counts(tokens), "token long, n long"), "op6-counts")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def _places(tokens: list[int]):
    def run(batches):
        for batch in batches:
            for raw in batch.column("content"):
                _, doc_ids, counts, matrix = read_shard(raw.as_py())
                ends = np.cumsum(counts)
                for t in tokens:
                    at = np.array(matrix.occurrences(t), dtype=np.int64)
                    doc = np.searchsorted(ends, at, side="right")
                    yield pa.record_batch([pa.array([t] * len(at), pa.int64()), pa.array([doc_ids[d] for d in doc], pa.int64()),
                                           pa.array(at - (ends - counts)[doc])], names=["token", "doc_id", "place"])
    return run


def locate_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, doc_id, place: every occurrence of the given ids, as the place within its document; by rank and select."""
    tokens = sorted(set(tokens))
    with shard_by_shard(spark):
        return written(_files(spark, path).mapInArrow(_places(tokens), "token long, doc_id long, place long"), "op6-places")


def _range_of(start: int, stop: int):
    def run(batches):
        for batch in batches:
            for raw in batch.column("content"):
                _, doc_ids, counts, matrix = read_shard(raw.as_py())
                first = np.cumsum(counts) - counts
                lo, hi = first + np.minimum(start, counts), first + np.minimum(stop, counts)
                ids = matrix.access(ragged(lo, hi - lo))
                ends = np.cumsum(hi - lo)
                yield pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array([ids[a:b].tolist() for a, b in zip(ends - (hi - lo), ends)], pa.list_(pa.int64()))],
                                      names=["doc_id", "ids"])
    return run


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """doc_id, ids: the ids at places start to stop - 1 of every document, by access to these places alone."""
    with shard_by_shard(spark):
        return written(_files(spark, path).mapInArrow(_range_of(start, stop), "doc_id long, ids array<long>"), "op6-range")


def round_trip(docs: DataFrame, vocabulary: str | None = None, **options) -> DataFrame:
    path = scratch_path(docs.sparkSession, "op6-shards")
    write_tokens(docs, path, vocabulary, **options)
    return read_tokens(docs.sparkSession, path)

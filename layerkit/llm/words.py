"""Words of whole texts as NumPy arrays of 64-bit hashes.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; the six separators are ASCII, so
working on UTF-8 bytes gives the same words as working on characters. Arrow columns are read
without building Python strings. Every array is bounded: rows are taken in pieces of about
``PIECE`` bytes, and one very long text is hashed in blocks of ``BLOCK`` bytes.
"""

from __future__ import annotations

import gc
import hashlib
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 21      # bytes of text handled at once (one longer text is a piece of its own)
BLOCK = 1 << 19      # bytes hashed at once
_MASK = (1 << 64) - 1
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, _MASK, size=256, dtype=np.uint64)
_BYTE_VALUE_LOWER = _BYTE_VALUE.copy()
_BYTE_VALUE_LOWER[65:91] = _BYTE_VALUE[97:123]


def process_cache() -> dict:
    """A dictionary that lives as long as the worker process. (Code sent by value brings its globals anew
    with every task; large tables among them would pile up.)"""
    return sys.modules.setdefault("_layerkit_llm_process", types.ModuleType("_layerkit_llm_process")).__dict__


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept per process, grown by doubling)."""
    _powers = process_cache().setdefault("powers", {})
    size = 1 << max(10, int(n).bit_length())
    key = next((k for k in _powers if k[0] == base and k[1] >= size), (base, size))
    if key not in _powers:
        t = np.ones(size, dtype=np.uint64)
        filled, step = 1, np.uint64(base)
        while filled < size:
            t[filled:2 * filled] = t[:filled] * step
            filled *= 2
            step = np.uint64((int(step) * int(step)) & _MASK)
        for old in [k for k in _powers if k[0] == base]:
            del _powers[old]
        _powers[key] = t
    return _powers[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that any bits of a hash can be used."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_hash(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[lo:hi] for many segments: prefix sums of a polynomial modulo 2**64."""
    n = len(values)
    power = _power_table(base, n + 1)
    inverse = _power_table(pow(base, -1, 1 << 64), n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * power[:n], out=prefix[1:])
    length = (hi - lo).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix((prefix[hi] - prefix[lo]) * inverse[lo] + length)


class Words(NamedTuple):
    """Words of rows ``first .. first + len(bounds) - 2`` of a batch.

    ``hashes``/``starts``/``ends`` are per word (byte positions into ``data``); the words of the
    i-th row are ``bounds[i]:bounds[i + 1]`` and its bytes ``offsets[i]:offsets[i + 1]``.
    """

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


_task: list[bool] = []      # one entry once this task has begun


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end; a row boundary ends a word."""
    inside = ~_SEPARATOR[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    cuts = cuts[cuts > 0]
    after[cuts - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One hash per span of bytes; ``lower`` treats A-Z as a-z."""
    table = _BYTE_VALUE_LOWER if lower else _BYTE_VALUE
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + BLOCK, side="right"))
        if j <= i:        # one word longer than a block
            word = data[starts[i]:ends[i]].tobytes()
            word = word.translate(_LOWER) if lower else word
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            i += 1
            continue
        a, b = int(starts[i]), int(ends[j - 1])
        out[i:j] = _segment_hash(table[data[a:b]], starts[i:j] - a, ends[i:j] - a, _BYTE_BASE)
        i = j
    return out


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows holding about ``limit`` bytes."""
    data, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_batches(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    if not _task:
        _task.append(True)
        gc.collect()        # the globals of the worker's earlier tasks
    for first, data, offsets in pieces(column):
        starts, ends = word_spans(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        yield Words(first, data, offsets, starts, ends, bounds, hash_spans(data, starts, ends, lower))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words (runs across rows are included; mask them)."""
    n = max(0, len(hashes) - k + 1)
    lo = np.arange(n)
    return _segment_hash(hashes, lo, lo + k, _WORD_BASE) if n else np.zeros(0, dtype=np.uint64)


def span_hashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the word sequences hashes[lo:hi]."""
    return _segment_hash(hashes, lo, hi, _WORD_BASE)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges starts[i] .. starts[i] + counts[i] - 1."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)

"""Token ids of many words through a bounded cache.

Words are the runs between ASCII blanks; the tokenizers here never join text across a blank, so the ids
of a text are the ids of its words one after the other. To have fewer different words, texts are first
prepared in ways that leave their ids alone: A-Z becomes lower case (the normaliser does it anyway; not before a
combining mark, U+0300 to U+036F, which may compose with one case only), and a
blank is put where a letter or digit is followed by an ASCII mark other than the apostrophe (the split
pattern parts them anyway). Pieces that hold the string of a special token are left as they are.

The cache belongs to the worker process and is emptied when it holds ``CACHE_WORDS`` words, so memory does
not grow with the vocabulary of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import process_cache, ragged

CACHE_WORDS = 700_000
ID_PIECE = 6 << 20      # bytes of text encoded at once: the more, the fewer look-ups per word
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = True


class WordIds:
    def __init__(self, encode_words: Callable[[list[str]], Iterable[np.ndarray]], most: int = CACHE_WORDS):
        self.encode_words, self.most = encode_words, most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)      # of the word's ids in flat; one more than words
        self.words = 0

    def _add(self, words: list[str]) -> None:
        encoded = list(self.encode_words(words))
        sizes = np.array([len(x) for x in encoded])
        first = self.starts[self.words]
        need = first + int(sizes.sum())
        while need > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.words + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        self.flat[first:need] = np.concatenate(encoded)
        self.starts[self.words + 1:self.words + len(words) + 1] = first + np.cumsum(sizes)
        self.place.update(zip(words, range(self.words, self.words + len(words))))
        self.words += len(words)

    def places(self, words: list[str]) -> np.ndarray:
        """Numbers of different words, which become known."""
        at = list(map(self.place.get, words))
        new = [w for w, place in zip(words, at) if place is None]
        if new:
            if self.words + len(new) > self.most:
                self.clear()
                new = words
            self._add(new)
            at = list(map(self.place.__getitem__, words))
        return np.array(at, dtype=np.int64)

    def ids(self, words: list[str], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words[index[0]], words[index[1]], ..., number of ids of each)."""
        if not len(index):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        at = self.places(words)[index]
        counts = self.starts[at + 1] - self.starts[at]
        return self.flat[ragged(self.starts[at], counts)], counts


def prepared(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the same ids and fewer different words."""
    lower = data.tobytes().lower()
    if any(s in lower for s in SPECIAL):
        return data, offsets
    d = np.frombuffer(lower, dtype=np.uint8)
    if len(d) < 2:
        return d, offsets
    marked = np.flatnonzero((d[1:] & 0xFE) == 0xCC)           # the two lead bytes of these marks
    if len(marked):
        d = d.copy()
        d[marked] = data[marked]
    # ASCII letters and digits, and the two-byte letters U+00C0 to U+00FF
    letter = _ALNUM[d]
    letter[1:] |= (d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] != 0x97) & (d[1:] != 0xB7)
    cut = np.flatnonzero(letter[:-1] & _MARK[d[1:]]) + 1
    return np.insert(d, cut, 0x20), offsets + np.searchsorted(cut, offsets, side="left")


def text_ids(cache: WordIds, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, bounds of each text's ids) of texts data[offsets[i]:offsets[i + 1]]. A text of more than
    ``ID_PIECE`` bytes is taken in blocks that end at blanks."""
    if len(offsets) == 2 and len(data) > ID_PIECE:
        parts, at = [], 0
        while at < len(data):
            end = at + ID_PIECE
            if end < len(data):
                blank = np.flatnonzero(data[at + 1:end] == 0x20)
                if not len(blank):                     # a very long word
                    rest = data[end:].tobytes().find(b" ")
                    blank = [(rest if rest >= 0 else len(data) - end) + ID_PIECE - 1]
                end = at + 1 + int(blank[-1])
            end = min(end, len(data))
            parts.append(text_ids(cache, data[at:end], np.array([0, end - at]))[0] if end - at < len(data) else _ids(cache, data, offsets)[0])
            at = end
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])
    return _ids(cache, data, offsets)


def _ids(cache: WordIds, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = prepared(data, offsets)
    texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(texts)
    words = split.values.dictionary_encode()
    ids, counts = cache.ids(words.dictionary.to_pylist(), words.indices.to_numpy())
    ends = np.concatenate(([0], np.cumsum(counts)))
    return ids, ends[np.asarray(split.offsets)]

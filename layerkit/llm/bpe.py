"""BPE by backtracking over longest matches, and decoding by an offset table.

The vocabulary is a list of byte sequences with a merge rank each. An Aho-Corasick automaton finds, for
every place of a piece of text, the tokens that start there. The encoder takes the longest one; it may
follow the token before it only when the two are compatible, otherwise it tries the next shorter token,
and goes one token back when none fits. Places that turned out to be dead ends are marked, so each is left
once and the work is linear in the text. Two tokens are compatible when merging their joint text by rank never
merges across their border; that is read off the merges along the right edge of the first and the left
edge of the second token, and kept in a table. The only sequence of compatible tokens is the one that
merging pair by pair gives.

Before that a text is normalised and split as the vocabulary file says: NFC, white space, lower case, the
split pattern, byte symbols, and a marker on the last byte of each piece. The marked bytes are symbols
of their own here (256 + byte), so a piece is a plain sequence of symbols. Words outside ASCII are normalised and split
by the library's own normaliser and splitter: which characters are letters, and what their lower case is, depends on
its version of Unicode. Ids and text are hashed in blocks, and a long text is encoded in blocks.

Decoding has one string that holds the text of every token and a table of offsets into it.

Defined results: a null text counts as empty and has no ids; rows that repeat a doc_id are encoded each for
itself; the strings of special tokens in a text give their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import bound_arrow, texts
from .wordids import ID_PIECE, WordIds, text_ids
from .words import pieces, process_cache, ragged

VOCABULARY = "word_bpe_49k.json"
WORDS = 250_000              # words whose ids a worker keeps
TABLE_IDS = 1 << 16          # ids turned into bytes at once
PAIR_TABLE = 400_000       # entries of the compatibility table of a worker, emptied when full


def _byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable ones for themselves, the others
    from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BacktrackingBpe:
    """Encoder and decoder for a vocabulary file with an end-of-piece suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs a task per core
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        self.normalise, self.split_normal = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.to_byte = _byte_symbols()
        model, to_byte = spec["model"], self.to_byte
        suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern, regex.V0)
        self.special = regex.compile("|".join(map(regex.escape, self.specials)))
        vocabulary = model["vocab"]

        def symbols(token: str) -> str:
            marked = token.endswith(suffix)
            units = [to_byte[c] for c in (token[:-len(suffix)] if marked else token)]
            if marked:
                units[-1] += 256
            return "".join(map(chr, units))

        self.text_of = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.specials.items()}
        self.id_of = {symbols(t): i for t, i in vocabulary.items()}
        n = max(self.text_of) + 1
        self.rank = [-1] * n                  # when the token is made by merging; -1: a single symbol
        self.parts: list[tuple[int, int] | None] = [None] * n
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.merge[a, b] = rank
            self.rank[made], self.parts[made] = rank, (a, b)
        self.length = [0] * n
        self.compatible: dict[tuple[int, int], bool] = {}
        # a token that merging never leaves whole cannot be a match
        usable = {s: i for s, i in self.id_of.items() if self._reachable(i)}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        self.shorter = [-1] * n               # longest usable token that is a proper prefix
        for s, i in usable.items():
            self.length[i] = len(s)
            self.automaton.add_word(s, (i, len(s)))
            self.shorter[i] = next((usable[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in usable), -1)
        self.automaton.make_automaton()
        pieces_ = [self.text_of.get(i, "").encode() for i in range(n)]
        self.text_table = offset_table([p + b" " for p in pieces_])
        self.decimal_table = offset_table([b"%d " % i for i in range(n)])

    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own text ends in the token: its parts must be whole and must not
        merge across their border before the last merge."""
        stack = [token]
        while stack:
            t = stack.pop()
            if self.parts[t] is None:
                continue
            a, b = self.parts[t]
            if not self._apart(a, b, self.rank[t]):
                return False
            stack += [a, b]
        return True

    def _apart(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether left and right stay apart (until the given rank) when their joint text is merged.

        Going back in time, the later made of the two neighbours is undone. A merge across the border
        happened if its rank comes before the merge that used up one of the two; of two equal ranks the
        one further left comes first."""
        never = len(self.merge) + 1
        end_left = end_right = never if until is None else until
        first = until is not None
        while True:
            rank = self.merge.get((left, right), never)
            if not first and rank < end_left and rank <= end_right and rank < never:
                return False
            first = False
            if self.rank[left] > self.rank[right]:
                end_left, left = self.rank[left], self.parts[left][1]
            elif self.parts[right] is not None:
                end_right, right = self.rank[right], self.parts[right][0]
            else:
                return True

    def pair(self, left: int, right: int) -> bool:
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= PAIR_TABLE:
                self.compatible.clear()
            known = self.compatible[left, right] = self._apart(left, right)
        return known

    def encode_piece(self, units: str) -> list[int]:
        """Ids of a sequence of symbols."""
        whole = self.id_of.get(units)
        if whole is not None and self.length[whole]:
            return [whole]
        n = len(units)
        longest = [-1] * n
        length = self.length
        for end, (token, size) in self.automaton.iter(units):
            start = end - size + 1
            if longest[start] < 0 or length[longest[start]] < size:
                longest[start] = token
        open_ = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n or not out:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + length[token]
                if open_[end] and (last < 0 or self.pair(last, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:                      # a dead end: go back and try a shorter token there
                open_[at] = False
                token = out.pop()
                at -= length[token]
        return out

    def encode_word(self, text: str) -> np.ndarray:
        """Ids of a text without blanks."""
        out: list[int] = []
        at = 0
        for m in self.special.finditer(text) if "<|" in text else ():
            out += self._plain(text[at:m.start()])
            out.append(self.specials[m[0]])
            at = m.end()
        out += self._plain(text[at:])
        return np.array(out, dtype=np.uint32)

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        if text.isascii():
            pieces_ = (p.encode("ascii") for p in self.split.findall(text.lower()))
        else:                      # the splitter gives byte symbols
            pieces_ = (bytes(map(self.to_byte.__getitem__, p)) for p, _ in self.split_normal(self.normalise(text)))
        for raw in pieces_:
            out += self.encode_piece(raw[:-1].decode("latin-1") + chr(raw[-1] + 256))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of the ids, one blank between tokens."""
        return b"".join(from_table(self.text_table, ids))

    def decimals(self, ids: np.ndarray) -> bytes:
        return b"".join(from_table(self.decimal_table, ids))


def offset_table(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(strings), dtype=np.uint8),
            np.concatenate(([0], np.cumsum([len(s) for s in strings]))))


def from_table(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> Iterator[bytes]:
    """The strings of the ids one after the other in blocks, without the last byte (a blank)."""
    data, offsets = table
    for k in range(0, len(ids), TABLE_IDS):
        some = ids[k:k + TABLE_IDS].astype(np.int64)
        block = data[ragged(offsets[some], offsets[some + 1] - offsets[some])].tobytes()
        yield block if k + TABLE_IDS < len(ids) else block[:-1]


def _sha256(blocks: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for block in blocks:
        digest.update(block)
    return digest.hexdigest()


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def tokenizer(path: str | None) -> tuple[BacktrackingBpe, WordIds]:
    """The encoder of this worker process."""
    held = process_cache()
    path = path or default_vocabulary()
    if ("bpe", path) not in held:
        bpe = BacktrackingBpe(path)
        held["bpe", path] = bpe, WordIds(lambda words: map(bpe.encode_word, words), most=WORDS)
    return held["bpe", path]


def _encode(path, carry=()):
    def run(batches):
        bpe, cache = tokenizer(path)
        for batch in batches:
            for first, data, offsets in pieces(batch.column("text"), ID_PIECE):
                ids, bounds = text_ids(cache, data, offsets)
                n = len(bounds) - 1
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, n), pa.array(np.diff(bounds)),
                     pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())]
                    + [batch.column(c).slice(first, n) for c in carry],
                    names=["doc_id", "n_tokens", "ids", *carry])
    return run


def _digest(path):
    def run(batches):
        bpe, cache = tokenizer(path)
        for batch in batches:
            for first, data, offsets in pieces(batch.column("text"), ID_PIECE):
                ids, bounds = text_ids(cache, data, offsets)
                spans = list(zip(bounds[:-1], bounds[1:]))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, len(spans)), pa.array(np.diff(bounds)),
                     pa.array([_sha256(from_table(bpe.decimal_table, ids[a:b])) for a, b in spans]),
                     pa.array([_sha256(from_table(bpe.text_table, ids[a:b])) for a, b in spans])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _decode(path):
    def run(batches):
        bpe, _ = tokenizer(path)
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array(
                [bpe.decode(np.frombuffer(x or b"", "<u4")).decode("utf-8") for x in batch.column("ids").to_pylist()], pa.string())],
                names=["doc_id", "text"])
    return run


def encode(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers). ``path``: the vocabulary file, at the
    same place on every executor. ``carry``: more columns (long)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *carry)
    return bound_arrow(rows).mapInArrow(_encode(path, carry), "doc_id long, n_tokens long, ids binary" + "".join(f", {c} long" for c in carry))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of encoded ids."""
    return bound_arrow(encoded.select("doc_id", "ids")).mapInArrow(_decode(path), "doc_id long, text string")


def round_trip_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return bound_arrow(texts(docs)).mapInArrow(
        _digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Groups spelling variants by composing finite-state machines.

The vocabulary acceptor A is composed with the transducer T of exactly one edit (one letter inserted,
deleted or replaced; all others copied) and with A again; the accepted pairs are the near words. The
composition is cut into partitions by initial state, so that no machine of the whole vocabulary is needed:

1. Words are counted: runs of letters of whole texts, pre-aggregated per task, then summed by word.
2. For a shorter word of ``m`` letters the place of its edit lies in the first or in the second half. The
   letters of the other half are read unchanged by all three machines: they fix the initial states, and
   words with the same such letters form a partition (key: m, the half, the letters). A word takes part as
   one of m letters and as the longer one of a pair, so in four partitions.
3. Partitions are counted. One of more than ``block`` words is dealt again, by single places instead of
   halves; then only the words that differ in one letter (two for the longer ones) are together, a
   number bounded by the alphabet. Partitions of one word have no pairs and are left out.
4. Per partition the minimal acceptors of what the words hold in the open half are built, with shared
   states for equal rests, and composed depth first: while no edit is used all three machines read one
   prefix, after it the rests common to two states are asked for, once per pair of states. An edit in a
   run of equal letters has several places; the last of them counts, so each pair comes once in all.
5. Per word the near words are counted and the best is kept inside the partition, then over partitions.
   Forms at least double the count, so chains are short; roots come by pointer doubling over written tables.

Defined results: a null or empty text has no words; rows that repeat are counted as often as they occur; a
null doc_id stands as an empty string in the hash; ties among near words go to the smallest in code-point
order; an empty table gives an empty result; other columns, of any name, play no part; very long runs are
words like others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runs import lower_ascii, pieces
from .scratch import bound_arrow, written

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
SLIP = 97               # one run in so many (by its hash) loses a letter
BLOCK = 20_000          # words of a partition by halves
FLUSH = 400_000         # different words a task counts before it hands them on
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_OUTSIDE = re.compile("[^A-Za-zÀ-ÿ]")
_KEY = ["m", "lo", "hi", "left", "right"]


def words_of(doc_id, text: str | None) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one document, the letters that the hash takes out being gone."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for part in pieces(text or "", _OUTSIDE):
        for run, n in Counter(_RUN.findall(lower_ascii(part))).items():
            h = zlib.crc32(run.encode(), head)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            yield run, n


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points and ``least_count`` occurrences."""
    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in words_of(d, text.as_py()):
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= FLUSH:
                    yield out(counts)
                    counts.clear()
        yield out(counts)

    found = bound_arrow(docs.select("doc_id", "text")).mapInArrow(step, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- acceptors ----------------------------------------------------------------------------------

class Acceptors:
    """Minimal acceptors over one set of shared states: a state is its arcs, so equal rests are one state.

    State 0 accepts the empty rest. All words of an acceptor have the same length.
    """

    def __init__(self):
        self.arcs: list[tuple[tuple[str, int], ...]] = [()]
        self._known: dict[tuple, int] = {(): 0}
        self._common: dict[tuple[int, int], list[str]] = {}

    def add(self, words: list[str]) -> int | None:
        """The initial state of the acceptor of sorted distinct words of one length."""
        if not words:
            return None
        path: list[list[tuple[str, int]]] = [[] for _ in range(len(words[0]) + 1)]   # arcs of the open states
        before = words[0]
        for word in words[1:]:
            same = next(i for i, (a, b) in enumerate(zip(before, word)) if a != b)
            self._close(path, before, same)
            before = word
        self._close(path, before, -1)
        return self._state(path[0])

    def _close(self, path, word, same) -> None:
        for i in range(len(word) - 1, max(same, 0) - 1, -1):
            path[i].append((word[i], self._state(path[i + 1])))
            path[i + 1] = []

    def _state(self, arcs) -> int:
        key = tuple(arcs)
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(key)
        return self._known[key]

    def common(self, p: int, q: int) -> list[str]:
        """Rests accepted from both states."""
        if p == 0 or q == 0:
            return [""] if p == q else []
        key = (p, q) if p < q else (q, p)
        found = self._common.get(key)
        if found is None:
            if p == q:
                found = [a + rest for a, s in self.arcs[p] for rest in self.common(s, s)]
            else:
                other = dict(self.arcs[q])
                found = [a + rest for a, s in self.arcs[p] if a in other for rest in self.common(s, other[a])]
            self._common[key] = found
        return found

    def replaced(self, start: int | None) -> Iterator[tuple[str, str]]:
        """Pairs of words of one acceptor with one letter replaced."""
        todo = [("", start)] if start else []
        while todo:
            prefix, p = todo.pop()
            arcs = self.arcs[p]
            for i, (a, s) in enumerate(arcs):
                for b, t in arcs[i + 1:]:
                    for rest in self.common(s, t):
                        yield prefix + a + rest, prefix + b + rest
                if s:
                    todo.append((prefix + a, s))

    def inserted(self, short: int | None, long: int | None, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs (x, y) where y is x with one letter more; ``at_end``: also behind the last letter of x."""
        todo = [("", short, long)] if short is not None and long is not None else []
        while todo:
            prefix, p, q = todo.pop()
            if p == 0 and not at_end:
                continue
            for b, t in self.arcs[q]:
                for rest in self.common(p, t):
                    if not rest.startswith(b):       # else the letter could stand further on
                        yield prefix + rest, prefix + b + rest
            follow = dict(self.arcs[q])
            todo.extend((prefix + a, s, follow[a]) for a, s in self.arcs[p] if a in follow)


def near_in_partition(rows: list[tuple[str, int]], m: int, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Pairs of row numbers of near words. rows: (letters in the open part, length of the word)."""
    short = {x: k for k, (x, length) in enumerate(rows) if length == m}
    long = {x: k for k, (x, length) in enumerate(rows) if length != m}
    machine = Acceptors()
    a, b = machine.add(sorted(short)), machine.add(sorted(long))
    for x, y in machine.replaced(a):
        yield short[x], short[y]
    for x, y in machine.inserted(a, b, at_end=hi == m):
        yield short[x], long[y]


# ---- partitions ---------------------------------------------------------------------------------

def _open_part(longer: Column) -> dict[str, Column]:
    """The letters before, in and behind the places lo..hi-1 of a word that is ``longer`` letters over m."""
    word, lo, hi = F.col("word"), F.col("lo"), F.col("hi")
    return {"left": F.substring(word, F.lit(1), lo), "mid": F.substring(word, lo + 1, hi - lo + longer),
            "right": F.substring(word, hi + longer + 1, F.col("length"))}


def partitions(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, length, mid and the key (m, lo, hi, left, right) of each partition with at least two words."""
    length = F.char_length("word")
    halves = F.expr("filter(array(named_struct('m', length, 'first', true), named_struct('m', length, 'first', false), "
                    f"named_struct('m', length - 1, 'first', true), named_struct('m', length - 1, 'first', false)), x -> x.m >= {LEAST_LENGTH})")
    half = F.floor(F.col("m") / 2).cast("int")
    rows = (vocab.withColumn("length", length).select("word", "n", "length", F.explode(halves).alias("p")).select("word", "n", "length", "p.m", "p.first")
            .select("word", "n", "length", "m", F.when(F.col("first"), 0).otherwise(half).alias("lo"), F.when(F.col("first"), half).otherwise(F.col("m")).alias("hi")))
    longer = F.col("length") - F.col("m")
    keyed = rows.withColumns(_open_part(longer))
    sizes = written(keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "op11-sizes")
    live = keyed.join(sizes, _KEY)
    columns = ["word", "n", "length", "mid", *_KEY]
    fine = (live.where(F.col("size") > block).select("word", "n", "length", "m", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("lo"))
            .withColumn("hi", F.col("lo") + 1).withColumns(_open_part(longer)))
    return live.where(F.col("size") <= block).select(*columns).unionByName(fine.select(*columns))


def _partition_step(batches: Iterator[pa.RecordBatch], pairs: bool) -> Iterator[pa.RecordBatch]:
    """Runs over the rows of a task, which are sorted by key."""
    def near(key, rows):
        m, lo, hi, left, right = key
        found = near_in_partition([(r[3], r[2]) for r in rows], m, lo, hi)
        if pairs:
            for i, j in found:
                yield rows[i][0], rows[j][0]
            return
        best: dict[int, list] = {}
        for i, j in found:
            for a, b in ((i, j), (j, i)):
                offer = (-rows[b][1], rows[b][0])
                mine = best.setdefault(a, [0, offer])
                mine[0] += 1
                if offer < mine[1]:
                    mine[1] = offer
        for k, (count, (falling, form)) in best.items():
            yield rows[k][0], count, -falling, form

    schema = pa.schema([("word", pa.string()), ("near", pa.string())] if pairs else
                       [("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    out, key, rows = [], None, []
    for batch in batches:
        table = [c.to_pylist() for c in batch.columns]
        for row in zip(*table):
            if row[4:] != key:
                if len(rows) > 1:
                    out.extend(near(key, rows))
                key, rows = row[4:], []
            rows.append(row[:4])
        while len(out) >= 20_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out[:20_000]], schema=schema)
            out = out[20_000:]
    if len(rows) > 1:
        out.extend(near(key, rows))
    for k in range(0, len(out), 20_000):
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out[k:k + 20_000]], schema=schema)


def _composed(vocab: DataFrame, block: int, pairs: bool) -> DataFrame:
    dealt = partitions(vocab, block).select("word", "n", "length", "mid", *_KEY).repartition(*_KEY).sortWithinPartitions(*_KEY)
    schema = "word string, near string" if pairs else "word string, n_near long, form_n long, form string"
    return bound_arrow(dealt).mapInArrow(lambda batches: _partition_step(batches, pairs), schema)


def near_pairs(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near): each pair of near words of the vocabulary once."""
    return _composed(vocab, block, pairs=True)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the pointers are doubled until none moves."""
    now = written(forms.select("word", F.col("form").alias("root")), "op11-forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                      "op11-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(vocab: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of a table (word, n) with distinct words."""
    vocab = written(vocab.select("word", "n"), "op11-words")
    none = F.lit(None)
    near = _composed(vocab, block, pairs=False).select(
        "word", none.cast("long").alias("n"), "n_near", F.struct((-F.col("form_n")).alias("falling"), F.col("form").alias("form")).alias("best"))
    own = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast(near.schema["best"].dataType).alias("best"))
    best = own.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    takes = -F.col("best.falling") >= ratio * F.col("n")
    judged = written(best.select("word", "n", "n_near", F.when(takes, F.col("best.form")).alias("form"), F.when(takes, -F.col("best.falling")).alias("form_n")),
                     "op11-judged")
    end = roots(judged.where("form is not null"))
    return judged.join(end, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, **options) -> DataFrame:
    """The words of whole texts with their forms and roots."""
    return group_variants(vocabulary(docs), **options)


ORACLE = r"""
with recursive bits(b, v, step) as (
  select range, range, 0 from range(256)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, step + 1 from bits where step < 8
), crc as (select list(v order by b) as t from bits where step = 8),
r as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
  group by doc_id, run
), x as (select doc_id, run, n, hex(encode(doc_id::varchar || ':' || run)) as x from r),
h(doc_id, run, n, x, pos, c) as (
  select doc_id, run, n, x, 1, 4294967295::bigint from x
  union all
  select doc_id, run, n, x, pos + 2, xor(c >> 8, t[(xor(c, ('0x' || substr(x, pos, 2))::bigint) & 255) + 1]) from h, crc where pos < length(x)
), k as (select doc_id, run, n, xor(c, 4294967295) as h from h where pos > length(x)),
w as (
  select word, sum(n)::bigint as n from (
    select n, case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from k)
  where length(word) >= 5 group by word having sum(n) >= 3
), v as (
  select word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) as rest from w, unnest(range(1, length(word) + 1)) as u(pos)
), p as (
  select a.word, a.n, b.word as near, b.n as near_n from v a join v b on a.pos = b.pos and a.rest = b.rest and a.word <> b.word
  union
  select v.word, v.n, w.word, w.n from v join w on v.rest = w.word
  union
  select w.word, w.n, v.word, v.n from v join w on v.rest = w.word
), best as (
  select word, n, near, near_n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by near_n desc, near) as place from p
), judged as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.near_n >= 2 * w.n then b.near end as form, case when b.near_n >= 2 * w.n then b.near_n end as form_n
  from w left join best b on w.word = b.word and b.place = 1
), up(word, pos) as (
  select word, word from judged
  union all
  select up.word, j.form from up join judged j on up.pos = j.word where j.form is not null
)
select j.word, j.form, up.pos as root, j.n, j.n_near, j.form_n
from judged j join up on up.word = j.word join judged e on e.word = up.pos and e.form is null
"""

"""Spelling variants, ranked search and line dedup against brute force, and on awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from layerkit.llm import fptree, lines, spelling
from layerkit.llm.runs import PIECE

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], SCHEMA).repartition(3)


def clashing(spark, docs):
    """The same rows among columns that carry the names the operators use."""
    return spark.createDataFrame([(5, d, 7, t, "x", "y", 1, "w") for d, t in docs], "n long, doc_id long, k1 int, text string, word string, `left` string, m int, terms string")


# ---- spelling -----------------------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs):
    counts = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def brute_groups(words):
    links = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in links.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), words[w], len(links[w]), words.get(form[w])) for w in words}


def variants(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def word_table(seed, count=260, alphabet="abé"):
    rng = random.Random(seed)
    words = {}
    while len(words) < count:
        words["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 11)))] = rng.choice((3, 4, 6, 8, 12, 25, 60, 200))
    words |= {"a" * n: 3 * n for n in range(5, 30)} | {"zz" + "q" * 400: 5, "zz" + "q" * 401: 50}
    return words


@pytest.mark.parametrize("block", [20_000, 2])
def test_op11_groups_against_brute_force(spark, block):
    words = word_table(3)
    vocab = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute_groups(words)
    assert variants(spelling.group_variants(vocab, block=block)) == want
    assert len({w for w, v in want.items() if v[1] not in (w, v[0])}) > 5        # chains of several forms


@pytest.mark.parametrize("block", [20_000, 2])
def test_op11_each_pair_once(spark, block):
    words = word_table(5, 150)
    got = [tuple(sorted((r["word"], r["near"]))) for r in spelling.near_pairs(spark.createDataFrame(list(words.items()), "word string, n long"), block).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


def test_op11_acceptors_are_minimal():
    words = sorted(a + b + c for a in "abc" for b in "xy" for c in ("tail", "tale"))
    machine = spelling.Acceptors()
    start = machine.add(words)
    assert machine.common(start, start) == words
    # t-a-i/l and their ends, then one state for each of the first letters' common rest: 7 letters, 8 states with the end
    assert len(machine.arcs) == 8
    assert set(machine.replaced(start)) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_op11_texts_against_brute_force(spark):
    rng = random.Random(8)
    stem = ["Straße", "CAFÉS", "planet", "plante", "×÷×÷×", "naïve", "letter", "lettre"]
    docs = [(i, " ".join(rng.choice(stem) + rng.choice(["", "", "s", "é", "1x"]) for _ in range(80))) for i in range(60)]
    docs += [(None, "planet planet letter"), (900, None), (901, ""), (901, ""), (902, "…"), (903, "planet " * 3), (903, "planet " * 3)]
    long = "k" * (PIECE + 10)
    docs += [(904 + i, "lettre " * 40000 + long + " Planets," * 3) for i in range(3)]
    words = brute_words(docs)
    assert any(len(w) >= PIECE for w in words)
    got = variants(spelling.spelling_variants(frame(spark, docs)))
    assert got == brute_groups(words)
    assert variants(spelling.spelling_variants(clashing(spark, docs))) == got


def test_op11_empty(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, "a b c")])).collect() == []


# ---- search -------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top=20):
    vectors = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    vectors = [(d, c) for d, c in vectors if c]
    total, length = len(vectors), sum(sum(c.values()) for _, c in vectors)
    df = Counter(t for _, c in vectors for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOW)))
        scored = []
        for d, c in vectors:
            m = 75 + (25 * sum(c.values()) * total) // length
            s = sum(r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in asked.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Été", "日本", "x_y", "UPPER"]
    docs = [(i * 3, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    docs += [(5, None), (8, ""), (11, "--"), (None, docs[7][1]), docs[9], docs[9], (14, "t1 " * 90000), (17, "t2 UPPER " * 3)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, items[2][1]), (103, items[2][1]), (None, "upper été")]
    return docs, items


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_terms", [100_000, 60])
def test_op12_against_brute_force(spark, block_terms):
    docs, items = corpus(1)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = found(fptree.ranked_search(frame(spark, docs), asked, block_terms=block_terms))
    assert got == brute_search(docs, items)
    if block_terms > 60:
        other = spark.createDataFrame([(d, t, 1, 2) for d, t in items], "item_id long, text string, doc_id int, score int")
        assert found(fptree.ranked_search(clashing(spark, docs), other)) == got


def test_op12_trees_share_bounds_and_prune():
    docs, items = corpus(2, 1500)
    vectors = [(d, Counter(TERM.findall(t.translate(LOW)))) for d, t in docs if t]
    vectors = [(d, c) for d, c in vectors if c]
    asked = [Counter(TERM.findall((t or "").translate(LOW))) for _, t in items]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*asked)))}
    df = Counter(vocabulary[t] for _, c in vectors for t in c if t in vocabulary)
    index = fptree.Index(asked, vocabulary, df, len(vectors))
    import numpy as np
    leaves = []
    for d, c in vectors:
        pairs = sorted((int(index.rank[vocabulary[t]]), n) for t, n in c.items() if t in vocabulary)
        leaves.append(fptree.Node(np.array([t for t, _ in pairs], np.int64), np.array([n for _, n in pairs], np.int64), 75 + sum(c.values()), (), (d,)))
    root = fptree.build_tree(leaves)
    below, nodes, seen = [root], 0, 0
    while below:
        node = below.pop()
        nodes += 1
        seen += node.doc is not None
        for child in node.children:
            shared = dict(zip(node.terms.tolist(), node.tfs.tolist()))
            assert node.m <= child.m and all(shared[t] >= n for t, n in zip(child.terms.tolist(), child.tfs.tolist()))
            below.append(child)
    assert seen == len(leaves)
    best = fptree.Best(index.items, 3)
    assert fptree.search(root, index, best) < nodes
    for i, heap in enumerate(best.heaps):
        want = sorted((int(b) for b in (index.bounds(x.terms, x.tfs, x.m)[i] for x in leaves) if b > 0), reverse=True)[:3]
        assert sorted((s for s, _, _ in heap), reverse=True) == want


def test_op12_small_trees(spark, monkeypatch):
    monkeypatch.setattr(fptree, "TREE_DOCS", 7)
    docs, items = corpus(4, 80)
    assert found(fptree.ranked_search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), top=4)) == brute_search(docs, items, 4)


def test_op12_empty(spark):
    docs, items = corpus(5, 10)
    none = spark.createDataFrame([], "item_id long, text string")
    assert fptree.ranked_search(frame(spark, docs), none).collect() == []
    assert fptree.ranked_search(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert fptree.ranked_search(frame(spark, docs), spark.createDataFrame([(1, "nowhere"), (2, None)], "item_id long, text string")).collect() == []


# ---- lines --------------------------------------------------------------------------------------

def brute_lines(docs, most=10):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(LOW)

    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(("id", d) if d is not None else ("text", t))
    out = []
    for d, t in docs:
        all_lines = (t or "").split("\n")
        stay = [x for x in all_lines if not key(x) or len(holders[key(x)]) < most]
        out.append((d, len(all_lines), len(all_lines) - len(stay), brute.sha("\n".join(stay))))
    return sorted(out, key=str)


def line_docs(seed=3):
    rng = random.Random(seed)
    common = ["Share this", "  ÉCRIT par", "\tnav | home \r", "", "0", "İx"]
    docs = []
    for i in range(90):
        body = [rng.choice(common).swapcase() if rng.random() < .3 else rng.choice(common) if rng.random() < .4 else f"own {rng.randrange(200)}" for _ in range(rng.randrange(1, 12))]
        docs.append((i, "\n".join(body)))
    docs += [(200, None), (201, ""), (202, "\n\n"), (203, "Share this"), (204, "share this\nshare this\n"), (205, "x\n" * 60000 + "Share this\n" + "y" * 400000)]
    docs += [(300, "only here\nown line")] * 12 + [(None, "no id line")] * 11 + [(None, f"other {i}\nno id") for i in range(10)]
    return docs


def counts(df):
    return sorted((tuple(r) for r in lines.digest(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def test_op13_against_brute_force(spark):
    docs = line_docs()
    want = brute_lines(docs)
    assert counts(lines.cleaned(frame(spark, docs))) == want
    assert counts(lines.cleaned(clashing(spark, docs))) == want
    assert sum(x[2] for x in want) > 100


def test_op13_keeps_the_other_columns(spark):
    docs = line_docs(5)
    df = clashing(spark, docs)
    out = lines.dedup_lines(df)
    assert out.columns == df.columns and out.schema == df.schema
    rows = out.collect()
    want = {d: h for d, _, _, h in brute_lines(docs) if d is not None}
    assert all(want[r["doc_id"]] == brute.sha(r["text"] or "") for r in rows if r["doc_id"] is not None)
    assert len(rows) == len(docs) and [r["text"] for r in rows if r["doc_id"] == 200] == [None]


def test_op13_other_limits_and_empty(spark):
    docs = line_docs(7)
    got = counts(lines.cleaned(frame(spark, docs), most_docs=2, least_chars=3))
    assert sum(r[2] for r in got) > 0
    assert lines.cleaned(frame(spark, [])).collect() == []

"""The training-data operators against brute force, DuckDB and the libraries, and on awkward rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from layerkit.llm import bpe, components, exactdedup, licenses, mixing, neardup, pii, quality, substring, toxicity, wavelet, wordids
from layerkit.llm.words import hash_spans, window_hashes, word_batches, word_spans

from . import brute
from ..conftest import SF001

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, docs, schema=SCHEMA):
    return spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}", len(t or "")) for d, t in docs], schema)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=1):
    """Shared passages, near copies, periodic text, odd blanks, nulls, empty and one long text."""
    rng = random.Random(seed)
    passage, base = prose(rng, 70), prose(rng, 160)
    docs = [None, "", " \n\t ", "one", "a b c d", "É é\x0bx\x0cy " + passage, passage, passage + " " + prose(rng, 30),
            prose(rng, 20) + " " + passage + "\n" + prose(rng, 40) + " " + passage, "tick " * 300, "tick tock " * 200,
            base, base, base.upper(), "x y   z"]
    for _ in range(25):                                   # a family of near copies around the threshold
        w = base.split()
        for _ in range(rng.randrange(1, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        docs.append(" ".join(w))
    docs += [prose(rng, rng.randrange(5, 120)) for _ in range(20)]
    docs.append(prose(rng, 30000, 5000) + " " + passage)
    rng.shuffle(docs)
    return list(enumerate(docs, start=3))


@pytest.fixture(scope="module")
def docs():
    return awkward()


@pytest.fixture(scope="module")
def df(spark, docs):
    return frame(spark, docs).repartition(5).cache()


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_words_are_the_runs_between_ascii_blanks(docs):
    column = pa.array([t for _, t in docs])
    got = []
    for w in word_batches(column):
        raw = w.data.tobytes()
        got += [[raw[w.starts[j]:w.ends[j]].decode() for j in range(a, b)] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
    assert got == [brute.words(t) for _, t in docs]


def test_hashes_depend_on_content_only():
    data = np.frombuffer(b"ab cd ab CD ab cd ab cd", np.uint8)
    s, e = word_spans(data, np.array([0, len(data)]))
    h = hash_spans(data, s, e, lower=False)
    assert h[0] == h[2] and h[1] != h[3] and hash_spans(data, s, e, lower=True)[3] == hash_spans(data, s, e, lower=True)[1]
    w = window_hashes(h, 2)
    assert w[0] == w[4] == w[6] and w[0] != w[1]


def test_op1_against_brute_force(df, docs):
    assert by_id(substring.digest(substring.remove_repeats(df)), "n_words", "n_removed", "kept_sha256") == brute.substring(docs)


def test_op1_short_windows_against_brute_force(spark):
    rng = random.Random(4)                       # a tiny vocabulary: branching nodes, cycles, self-overlaps
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    got = by_id(substring.digest(substring.remove_repeats(frame(spark, docs), k=8, minimiser=4)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring(docs, 8)


def test_op1_spans_name_their_source(spark):
    rng = random.Random(9)
    passage = prose(rng, 80)
    docs = [(1, prose(rng, 30) + " " + passage), (5, passage), (9, prose(rng, 7) + " " + passage)]
    spans = substring.repeated_spans(frame(spark, docs)).where("source_word is not null").collect()
    for r in spans:
        mine, source = brute.words(dict(docs)[r["doc_id"]]), brute.words(dict(docs)[r["source_doc"]])
        assert mine[r["word"]:r["word"] + r["words"]] == source[r["source_word"]:r["source_word"] + r["words"]]
    assert spans


def test_op1_verifies_at_the_coordinates(spark):
    rng = random.Random(41)
    passage = prose(rng, 80)
    docs = [(1, prose(rng, 30) + " " + passage), (5, passage + " " + prose(rng, 20)), (9, prose(rng, 100))]
    df = frame(spark, docs)
    key = {r["doc_id"]: r["text_key"] for r in substring._keyed(df).collect()}
    claims = [(5, key[5], 0, 80, 1, key[1], 30), (5, key[5], 10, 50, 1, key[1], 40), (5, key[5], 10, 50, 1, key[1], 41), (9, key[9], 0, 60, 5, key[5], 0)]
    spans = spark.createDataFrame(claims, "doc_id long, text_key long, word int, words int, source_doc long, source_key long, source_word int")
    assert sorted((r["doc_id"], r["word"], r["words"], r["source_word"]) for r in substring.verified(df, spans).collect()) == [(5, 0, 80, 30), (5, 10, 50, 40)]


def test_op1_colliding_hashes_remove_nothing_wrong(spark, monkeypatch):
    monkeypatch.setattr(substring, "span_hashes", lambda hashes, lo, hi: np.zeros(len(lo), np.uint64))    # every run looks the same
    rng = random.Random(43)
    passage = prose(rng, 70)
    docs = [(1, passage), (2, passage), (3, passage[:250] + " " + prose(rng, 60)), (4, prose(rng, 70))]
    got = by_id(substring.digest(substring.remove_repeats(frame(spark, docs))), "n_words", "n_removed", "kept_sha256")
    want = brute.substring(docs)
    assert all(got[d][1] <= want[d][1] for d in want) and got[4] == want[4] and got[2][1] <= 70


def test_op2_against_brute_force(df, docs):
    got = by_id(quality.measure_quality(df), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {d: brute.quality(t) for d, t in docs}


def test_op2_bands(spark):
    rng = random.Random(2)
    clean = " ".join("".join(rng.choice("etaoinshrdlucmfwygpb") for _ in range(rng.randrange(2, 9))) for _ in range(300))
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(6)) for _ in range(500))
    junk = " ".join(f"{w}%%%%%%%%" for w in clean.split())
    got = by_id(quality.measure_quality(frame(spark, [(1, clean), (2, noise), (3, junk)])), "base_failed", "kept", "ratio")
    assert got[1][:2] == (False, True) and got[2][:2] == (False, False) and got[3][:2] == (False, False)
    assert got[2][2] < got[1][2] < got[3][2]


def test_op2_judges_the_last_chunk():
    import base64
    import zstandard
    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    import pyarrow.parquet as pq
    rng = random.Random(21)
    texts = pq.read_table(f"{SF001}/documents.parquet").column("text").to_pylist()
    clean = [t.encode() for t in texts if t and len(t.encode()) > 8192 and quality.ratios(t.encode(), compress)[3]]
    junk = base64.b64encode(bytes(rng.randrange(256) for _ in range(1530)))
    assert clean and not any(quality.ratios(c[:4096] + junk, compress)[3] for c in clean)
    assert all(quality.ratios(c[:4096 + n], compress)[3] for c in clean for n in (1, 100, 1500))


def test_op2_verdict_on_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.measure_quality(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in rows}
    print("op2:", n)
    assert n.get((1, False), 0) <= 0.001 * n[1, True] and n[0, False] >= 0.2 * n[0, True]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_vocabulary())


def samples():
    rng = random.Random(3)
    parts = ["a", "b", "th", "e ", "ing", "'s", "  ", "Ω", "ß", "é", "1", "9", "!", "-", "\n", "日", "क", "ि", "é", "🎉", "İ", "Σ", ", ", ". ",
             "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "\x7f", " ", "×,", "É.", "in", "an", "er", "'"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(400)] + ["a" * 500, "!" * 333, "ab" * 200]


def test_op3_equals_the_library(spark, library):
    docs = list(enumerate(samples())) + [(9001, None), (9002, "")]
    encoded = bpe.encode(frame(spark, docs)).cache()
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in encoded.collect()}
    want = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in docs}
    assert ids == want
    decoded = by_id(bpe.decode(encoded), "text")
    assert decoded == {d: (library.decode(i, skip_special_tokens=False),) for d, i in want.items()}
    digest = by_id(bpe.round_trip_digest(frame(spark, docs)), "n_tokens", "ids_sha256", "decoded_sha256")
    assert digest == {d: (len(i), brute.sha(" ".join(map(str, i))), brute.sha(library.decode(i, skip_special_tokens=False)))
                      for d, i in want.items()}


def test_op3_equals_the_library_on_every_code_point(library):
    encoder = bpe.BacktrackingBpe(bpe.default_vocabulary())
    points = [c for c in (*range(0x21, 0x32000), *range(0xE0000, 0xE0200), *range(0xF0000, 0xF0010)) if not 0xD800 <= c < 0xE000]
    different = []
    for k in range(0, len(points), 20_000):
        some = [f"a{chr(c)}!" for c in points[k:k + 20_000]]
        different += [w for w, e in zip(some, library.encode_batch(some, add_special_tokens=False)) if encoder.encode_word(w).tolist() != e.ids]
    assert different == []


def test_op3_equals_the_library_on_random_strings(library):
    rng = random.Random(23)
    encoder = bpe.BacktrackingBpe(bpe.default_vocabulary())
    cache = wordids.WordIds(lambda words: map(encoder.encode_word, words))
    blocks = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x530), (0x530, 0x600), (0x900, 0xD00), (0x1C80, 0x2100), (0x3040, 0x3100), (0xA640, 0xAC00), (0x1F300, 0x1F700)]
    texts = ["".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        got.append(wordids.text_ids(cache, raw, np.array([0, len(raw)]))[0].tolist())
    assert got == want


def test_op3_long_texts_are_taken_in_blocks(library, monkeypatch):
    encoder = bpe.BacktrackingBpe(bpe.default_vocabulary())
    cache = wordids.WordIds(lambda words: map(encoder.encode_word, words))
    monkeypatch.setattr(wordids, "ID_PIECE", 50)
    monkeypatch.setattr(bpe, "TABLE_IDS", 7)
    for text in (" ".join(samples()[:60]), "x" * 500, "ab " * 40 + "y" * 200 + " z" * 90, " " * 300, "é" * 90 + " <|endoftext|> " * 20):
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, bounds = wordids.text_ids(cache, raw, np.array([0, len(raw)]))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and bounds.tolist() == [0, len(want)]
        assert encoder.decimals(ids).decode() == " ".join(map(str, want))
        assert encoder.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_op3_memory_of_a_long_text():
    """A text of 50 MB within 600 MB, measured in a process of its own."""
    import subprocess
    import sys
    code = """
import resource, numpy as np, pyarrow as pa
from layerkit.llm import bpe
word = "".join(chr(97 + i * 7 % 26) + "é"[i % 5:] + " ." [i % 9 == 0] for i in range(1000))
batch = pa.record_batch([pa.array([1]), pa.array([word * (50_000_000 // len(word.encode()))])], names=["doc_id", "text"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows = [r for b in bpe._digest(None)([batch]) for r in b.to_pylist()]
print(rows[0]["n_tokens"], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)
"""
    from ..conftest import ROOT
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr
    tokens, peak = out.stdout.split()
    assert int(tokens) > 5_000_000 and float(peak) < 900       # 50 MB of text twice, ids, the vocabulary's tables


def test_op3_small_cache_gives_the_same_ids(library):
    encoder = bpe.BacktrackingBpe(bpe.default_vocabulary())
    cache = wordids.WordIds(lambda words: map(encoder.encode_word, words), most=40)
    for t in samples()[:80]:
        raw = np.frombuffer(t.encode(), np.uint8)
        assert wordids.text_ids(cache, raw, np.array([0, len(raw)]))[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_op4_base_spans(spark, docs):
    rng = random.Random(5)
    parts = ["a@b.co", "@", "x.y+z@m-n.example.org", ".", "1.2.3.4", "300.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (988) 555-2485", "+49.30.1234567", "+1-", " ", "é", "_d", "🎉", "5", "12 34", "\n", "aa", "--"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))) for i in range(400)] + [(900, None), (901, "9" * 5000 + "@" * 50)]
    got = by_id(pii.report(pii.find_personal_data(frame(spark, docs), threshold=9.0)), "base_sha256", "spans")
    want = {d: brute.pii(t) for d, t in docs}
    assert {d: s for d, (_, s) in got.items()} == want
    assert all(h == brute.sha(want[d]) for d, (h, _) in got.items())


def test_op4_disclosing_terms(spark):
    rng = random.Random(6)
    docs = [(i, f"{prose(rng, 12)} dragonfly met boss@corp.example.com {prose(rng, 12)}") for i in range(6)]
    docs += [(100 + i, prose(rng, 40)) for i in range(200)]
    df = frame(spark, docs)
    found = pii.find_personal_data(df).cache()
    got = by_id(pii.report(found), "n_email", "n_term", "spans")
    for d, t in docs:
        i = t.find("dragonfly")
        assert (f"term:{i}:{i + 9}" in got[d][2]) == (d < 6)
        assert got[d][1] == 0 or d < 6
    clean = by_id(pii.sanitise(df, found), "text")
    assert all("corp.example" not in t and "dragonfly" not in t for t, in clean.values())
    assert "[EMAIL]" in clean[0][0] and clean[100][0] == dict(docs)[100]


def test_op4_terms_of_rare_values_and_classes(spark):
    rng = random.Random(16)
    docs = [(i, prose(rng, 40)) for i in range(1500)]
    far = prose(rng, 60)                                     # more than 80 code points
    docs.append((2000, f"staff K7731 {far} mail one@solo.example.net {far}"))                   # a value in one document
    docs += [(2001 + i, f"QX {far} call +49 30 55512{i:02} {prose(rng, 5)}") for i in range(6)]    # a class; 2 letters
    found = pii.find_personal_data(frame(spark, docs))
    got = by_id(pii.report(found), "spans", "n_term")
    text = dict(docs)
    at = text[2000].index("K7731")
    assert f"term:{at}:{at + 5}" in got[2000][0].split(",")
    assert all("term:0:2" in got[2001 + i][0].split(",") for i in range(6))
    assert all(got[i][1] == 0 for i in range(1500))


def test_op5_targets_and_positions(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 40)), "en", rng.choice(["a"] * 30 + ["b", "c", "d", None, "", "é"]), 0) for i in range(3000)]
    df = spark.createDataFrame(rows + [(5000, None, "en", "a", 0)], SCHEMA)
    plan = mixing.plan_mix(df, bucket_rows=100).cache()
    got = mixing.taken(plan).join(df.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = r["source_size"]
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    targets, left, free = {}, float(sum(sizes.values())), set(order)
    while True:                                              # reshare until none is above
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not above:
            break
        for s in above:
            targets[s] = 3.0 * sizes[s]
        left -= sum(targets[s] for s in above)
        free -= set(above)
    targets |= {s: left * weight[s] / total for s in free}
    words = dict.fromkeys(order, 0)
    for r in got:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] <= 3 * r["size"]
        words[r["source"]] += r["taken"]
    for s in order:
        assert abs(words[s] - targets[s]) <= 40
    assert all(0 <= p <= 1 for r in plan.collect() for p in r["positions"])
    again = mixing.taken(mixing.plan_mix(df.repartition(7), bucket_rows=100))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in mixing.taken(plan).collect()}


def test_op5_stream_has_every_copy_in_order(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", "ab"[i % 2], 0) for i in range(60)] + [(7, "same row", "en", "a", 0)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    copies = sum(len(r["positions"]) for r in mixing.plan_mix(df).collect())
    stream = mixing.mix(df)
    assert stream.columns == df.columns and stream.count() == copies
    assert {r["text"] for r in stream.collect()} <= {t for _, t, *_ in rows}


def test_op6_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, top in ((0, 2), (1, 1), (5, 9), (511, 3), (512, 300), (3000, 70000)):
        values = rng.integers(0, top, size=n).astype(np.uint32)
        levels = max(1, int(values.max()).bit_length()) if n else 1
        m = wavelet.WaveletMatrix.build(values, levels)
        assert (m.values() == values).all()
        if n:
            at = rng.integers(0, n, size=50)
            assert (m.access(at) == values[at]).all()
            for v in {int(values[0]), int(values[-1]), 0, top}:
                lo, hi = sorted(rng.integers(0, n + 1, size=2).tolist())
                assert m.count(v, lo, hi) == int((values[lo:hi] == v).sum())
                assert m.occurrences(v, lo, hi) == (np.flatnonzero(values[lo:hi] == v) + lo).tolist()


def test_op6_round_trip_equals_the_library(spark, library):
    docs = list(enumerate(samples(), start=10)) + [(1, None), (2, "")]
    random.Random(1).shuffle(docs)
    got = by_id(wavelet.round_trip(frame(spark, docs), shard_tokens=500, partitions=3), "start", "n_tokens", "ids_crc32")
    start = 0
    for d, t in sorted(docs):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        assert got[d] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op6_answers_from_files(spark, library, tmp_area):
    rng = random.Random(31)
    docs = [(i, prose(rng, rng.randrange(0, 60), 30)) for i in range(80)] + [(None, "w1 w2"), (500, None)]
    path = f"{tmp_area}/shards"
    wavelet.write_tokens(frame(spark, docs), path, shard_tokens=400, partitions=3)
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [wavelet.END_ID] for d, t in docs}
    common = sorted({x for v in ids.values() for x in v}, key=lambda x: -sum(v.count(x) for v in ids.values()))
    asked = [*common[:3], common[-1], 1, 49_000, 1 << 20]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    try:
        assert {r["token"]: r["n"] for r in wavelet.count_tokens(spark, path, asked).collect()} == {t: sum(v.count(t) for v in ids.values()) for t in asked}
        got = sorted(((r["token"], r["doc_id"], r["place"]) for r in wavelet.locate_tokens(spark, path, asked).collect()), key=str)
        assert got == sorted(((t, d, k) for t in set(asked) for d, v in ids.items() for k, x in enumerate(v) if x == t), key=str)
        assert {r["doc_id"]: r["ids"] for r in wavelet.read_range(spark, path, 3, 9).collect()} == {d: v[3:9] for d, v in ids.items()}
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "777"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_op7_learns_and_locates(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        sentences = [prose(rng, 10) + "." for _ in range(6)]
        if toxic:
            sentences[rng.randrange(6)] = f"{prose(rng, 4)} {rng.choice(['vilefoo', 'vilebar', 'nastything'])} {prose(rng, 4)}."
        docs.append((i, " ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    docs += [(9000, None), (9001, "")]
    df = frame(spark, docs)
    lab = spark.createDataFrame(labels + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    weights = toxicity.train(df, lab)
    got = by_id(toxicity.score(df, weights), "held_out", "score", "predicted")
    held = [d for d, *_ in labels if got[d][0]]
    assert {d for d in held} == {d for d, *_ in labels if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(got[d][2] == int(d % 4 == 0) for d in held) >= 0.95 * len(held)
    assert got[9000][1] == got[9001][1] == 0.0
    hits = toxicity.offending_sentences(df, weights).collect()
    assert sum("vile" in r["sentence"] or "nasty" in r["sentence"] for r in hits) >= 0.95 * len(hits) > 0
    assert {r["doc_id"] for r in toxicity.remove_toxic(df, lab).collect()} == {d for d, v in got.items() if not v[2]}


def test_op7_held_out_accuracy_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)


def test_op7_sample_and_repeated_rows(spark):
    import inspect
    assert inspect.signature(toxicity.train).parameters["sample"].default == 3000
    rng = random.Random(13)
    docs = [(i, f"{prose(rng, 12)}. {prose(rng, 5)} {'vilefoo' if i % 3 == 0 else 'fair'}.") for i in range(120)]
    lab = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    once, repeated = (toxicity.train(frame(spark, d), lab) for d in (docs, docs + docs[:9] * 30))
    assert np.allclose(once, repeated) and once[:-1].any()


def test_op7_gradient_against_brute_force(spark):
    import math
    from pyspark.sql import functions as F
    rng = random.Random(17)
    n_places, bags, rows = 9, [], []
    for d in range(20):
        sentences = [[[rng.randrange(n_places + 1) for _ in range(3)] for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 4))]
        bags.append((d, d % 3 == 0, sentences))
        words = [w for s in sentences for w in s]
        at = [k for k, s in enumerate(sentences) for _ in s]
        rows.append((d, int(d % 3 == 0), len(sentences), np.array(words, np.int32).tobytes(), np.array(at, np.int32).tobytes()))
    share = (0.8 / 13, 0.2 / 7)
    w = np.array([rng.random() * 0.6 for _ in range(n_places)] + [0.0, -2.0])

    def loss(w):
        total = 0.0
        for _, toxic, sentences in bags:
            none = math.prod(1 - 1 / (1 + math.exp(-(w[-1] + sum(w[f] for word in s for f in word)))) for s in sentences)
            total -= share[toxic] * math.log(1 - none if toxic else none)
        return total

    table = spark.createDataFrame(rows, "doc_id long, toxic int, n_sentences int, features binary, sentences binary").repartition(4, F.col("doc_id"))
    value, gradient = toxicity.evaluator(table, len(w), share)(w)
    assert math.isclose(value, loss(w), rel_tol=1e-9)
    for j in [*range(n_places), n_places + 1]:
        step = np.zeros(len(w))
        step[j] = 1e-5
        assert math.isclose(gradient[j], (loss(w + step) - loss(w - step)) / 2e-5, rel_tol=1e-4, abs_tol=1e-8)
    assert gradient[n_places] == 0


def test_op7_descent_finds_the_minimum():
    target = np.array([0.0, 2.0, 0.0, 1.0, 0.0, -3.0])            # the place before the last is not used

    def evaluate(w):
        d = w - target
        scale = np.array([1.0, 4.0, 2.0, 9.0, 0.0, 1.0])
        gradient = scale * d
        gradient[0] += 1.0                                         # the loss falls towards negative weights
        return float((scale * d * d).sum() / 2 + w[0]), gradient
    w = toxicity.minimise(evaluate, np.zeros(6), steps=60)
    assert np.allclose(w, target, atol=0.1) and w[0] == 0 and w[2] == 0


def test_op7_labels_of_one_kind(spark):
    df = frame(spark, [(1, "a b"), (2, "c d")])
    lab = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert by_id(toxicity.toxicity(df, lab), "score", "predicted") == {1: (0.0, 0), 2: (0.0, 0)}


def test_op8_against_brute_force(df, docs):
    assert by_id(neardup.near_duplicates(df), "n_shingles", "component_id", "kept") == brute.near(docs)


def test_op8_blocks_find_links_the_first_member_misses(spark):
    rng = random.Random(12)
    chain = prose(rng, 60, 10 ** 6).split()
    docs = []
    for i in range(30):                                     # neighbours are similar, ends are not
        docs.append((i + 1, " ".join(chain)))
        chain[(i * 2) % 60] = f"q{i}"
    assert by_id(neardup.near_duplicates(frame(spark, docs)), "n_shingles", "component_id", "kept") == brute.near(docs)


def test_op8_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(2)
    assert [n for n, _ in neardup.LEAST][-1] == neardup.BANDS * neardup.ROWS
    equal = rng.random((2000, neardup.BANDS * neardup.ROWS)) < 0.8
    left = np.zeros_like(equal, dtype=np.uint32)
    every = np.arange(len(left))
    assert len(neardup.alive(left, (~equal).astype(np.uint32), (every, every))) == 2000
    different = rng.random(equal.shape) < 0.4
    assert len(neardup.alive(left, (~different).astype(np.uint32), (every, every))) == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 502), (501, 502)], "a long, b long")
    got = {r["vertex"]: r["component"] for r in components.components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500, 502: 500}


def brute_licenses(text, threshold=0.75):
    import re
    words = re.findall("[a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = []
    for k, (name, t) in enumerate(licenses.TEMPLATES):
        theirs, n = set(licenses.template_bigrams(t)), len(licenses.template_words(t))
        best = None
        for at, p in enumerate(pairs):
            if p in theirs:
                mine = set(pairs[at:at + n - 1])
                dice = round(2 * len(mine & theirs) / (len(mine) + len(theirs)), 6)
                if dice >= threshold and (best is None or dice > best[0]):
                    best = (dice, k, name, at, at + n)
        found += [best] if best else []
    stay = [x for x in found if not any(y[3] < x[4] and x[3] < y[4] and (y[0], -y[1]) > (x[0], -x[1]) for y in found)]
    return ",".join(sorted({x[2] for x in stay})), len(stay), max((x[0] for x in stay), default=0.0)


def wrapped(rng, text, changed=0.0):
    """The text in other lines and cases, with a share of its words replaced."""
    words = [w if rng.random() >= changed else f"w{rng.randrange(400)}" for w in text.split()]
    return "".join((w.upper() if rng.random() < .2 else w) + rng.choice([" ", " ", " ", "\n", "\n * ", "  "]) for w in words)


def test_op9_notices(spark):
    mit, apache = (next(t for n, t in licenses.TEMPLATES if n == name and len(t) > 300) for name in ("mit", "apache-2.0"))
    rng = random.Random(5)
    docs = [(1, "Some text\n  released under the MIT license \nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""),
            (5, "This work is licensed under\nthe GNU General Public License, version 3."), (6, "the licence of the poet is a public good"),
            (7, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY 4.0"),
            (8, prose(rng, 50) + "\n" + mit), (9, wrapped(rng, apache) + prose(rng, 40)), (10, "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\nint x;"),
            (11, prose(rng, 30) + " all of it Released under the MIT License. " + prose(rng, 30)), (12, "SPDX-License-Identifier:\tMIT\n# SPDX-License-Identifier: Apache-2.0 */")]
    got = by_id(licenses.scan_licenses(frame(spark, docs)), "licenses", "n_matches", "spdx")
    none = ("", 0, "")
    assert got == {1: ("mit", 1, ""), 2: ("apache-2.0", 1, ""), 3: none, 4: none, 5: ("gpl-3.0", 1, ""), 6: none, 7: ("cc-by-4.0,mit", 2, ""), 8: ("mit", 1, ""),
                   9: ("apache-2.0", 1, ""), 10: ("", 0, "GPL-2.0-only WITH Classpath-exception-2.0"), 11: ("mit", 1, ""), 12: ("", 0, "Apache-2.0,MIT")}


def test_op9_against_brute_force(spark):
    rng = random.Random(19)
    docs = []
    for i in range(200):
        parts = [prose(rng, rng.randrange(0, 40), 60) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), wrapped(rng, rng.choice(licenses.TEMPLATES)[1], rng.choice([0, 0.05, 0.1, 0.2, 0.4])))
        docs.append((i, "\n".join(parts)))
    docs += [(900, "the software " * 3000), (901, " ".join(t for _, t in licenses.TEMPLATES)), (902, "word"), (903, "Released under the MIT " * 50)]
    got = by_id(licenses.scan_licenses(frame(spark, docs)), "licenses", "n_matches", "best_dice")
    assert got == {d: brute_licenses(t) for d, t in docs}
    assert sum(v[1] > 0 for v in got.values()) > 80


@pytest.mark.parametrize("changed, least", [(0.05, 0.9), (0.1, 0.75)])
def test_op9_recall_on_changed_texts(spark, changed, least):
    rng = random.Random(29)
    docs = [(1000 * k + i, prose(rng, 30) + "\n" + wrapped(rng, t, changed) + "\n" + prose(rng, 30)) for k, (_, t) in enumerate(licenses.TEMPLATES) if len(t) > 300 for i in range(15)]
    got = by_id(licenses.scan_licenses(frame(spark, docs)), "licenses")
    caught = sum(licenses.TEMPLATES[d // 1000][0] in v[0].split(",") for d, v in got.items())
    print(f"op9: {caught} of {len(docs)} notices with {changed:.0%} of the words changed")
    assert caught >= least * len(docs)


def test_op10_groups(spark):
    docs = [(3, "a"), (7, "a"), (5, "b"), (None, "a"), (9, None), (8, ""), (2, "c"), (2, "c"), (None, "z")] + [(100 + i, "hot") for i in range(500)]
    got = exactdedup.exact_groups(frame(spark, docs).repartition(9), heavy=4, counters=16).collect()
    assert len(got) == len(docs)
    view = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in got}
    assert view[3, brute.sha("a")] == (7, 3, False) and view[7, brute.sha("a")] == (7, 3, True) and view[None, brute.sha("a")] == (7, 3, False)
    assert view[9, brute.sha("")] == (9, 2, True) and view[2, brute.sha("c")] == (2, 2, True) and view[None, brute.sha("z")] == (None, 1, True)
    assert view[599, brute.sha("hot")] == (599, 500, True) and view[100, brute.sha("hot")] == (599, 500, False)
    kept = exactdedup.exact_dedup(frame(spark, docs)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, "z"), (2, "c"), (2, "c"), (5, "b"), (7, "a"), (9, ""), (599, "hot")]


def test_op10_heavy_digests_are_found(spark):
    docs = [(i, f"hot{i % 3}" if i % 2 else f"t{i}") for i in range(3000)]
    heavy = exactdedup.heavy_digests(exactdedup.digests(frame(spark, docs)), heavy=8, counters=64).collect()
    assert sorted(r["group_size"] for r in heavy)[-3:] == [500, 500, 500]


OPERATORS = {
    "op1": lambda d, s: substring.digest(substring.remove_repeats(d)), "op2": lambda d, s: quality.measure_quality(d),
    "op3": lambda d, s: bpe.round_trip_digest(d), "op4": lambda d, s: pii.report(pii.find_personal_data(d)),
    "op5": lambda d, s: mixing.taken(mixing.plan_mix(d)), "op6": lambda d, s: wavelet.round_trip(d),
    "op7": lambda d, s: toxicity.toxicity(d, s.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")),
    "op8": lambda d, s: neardup.near_duplicates(d), "op9": lambda d, s: licenses.scan_licenses(d),
    "op10": lambda d, s: exactdedup.exact_groups(d)}
CLASHING = SCHEMA + ", id long, row long, bucket long, size long, word string, digest string, keep_id long, component_id long, positions long"


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA), spark).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_repeats_and_clashing_columns(spark, name):
    text = prose(random.Random(1), 120)
    rows = [(1, text), (2, text), (1, text), (1, text), (4, None), (None, text), (None, None), (6, ""), (7, "same id"), (7, "other text")]
    plain = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    wide = spark.createDataFrame([(d, t, None, None, None, 5, 5, 5, 5, "x", "x", 5, 5, 5) for d, t in rows], CLASHING)
    a, b = (sorted(map(str, OPERATORS[name](d, spark).collect())) for d in (plain, wide))
    assert len(a) == len(rows) and a == b


def test_stages_on_nulls_repeats_and_clashing_columns(spark):
    text = prose(random.Random(1), 120)
    rows = [(1, text), (2, text), (1, text), (4, None), (None, text), (6, ""), (7, "same id"), (7, "other text")]
    wide = spark.createDataFrame([(d, t, None, None, None, 5, 5, 5, 5, "x", "x", 5, 5, 5) for d, t in rows], CLASHING)
    for name, stage in corpus_pipeline.STAGES:
        for d in (wide, wide.limit(0)):
            out = stage(spark, d, SF001)
            assert name == "encode" or out.columns == wide.columns, name
            out.collect()
    kept = {(r["doc_id"], r["text"]) for r in exactdedup.exact_dedup(wide).collect()}
    assert kept == {(2, text), (6, ""), (7, "same id"), (7, "other text")}
    near = {(r["doc_id"], r["text"]) for r in neardup.near_dedup(wide).collect()}
    assert near >= {(1, text), (4, None), (6, ""), (7, "same id"), (7, "other text")} and (2, text) not in near


def test_pipeline_keeps_the_training_order(spark):
    from layerkit.llm.scratch import written
    rng = random.Random(17)                    # long and short files: the scan reads the large ones first
    rows = [(i, f"d{i} " + prose(rng, rng.choice([1, 3, 900])), "en", "abc"[i % 3], 0) for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).cache()
    want = [r["doc_id"] for r in mixed.collect()]
    out = corpus_pipeline.encode(spark, written(mixed, "order"), SF001)
    got = out.orderBy("position").collect()
    assert out.columns == ["doc_id", "n_tokens", "ids", "position"] and len({r["position"] for r in got}) == len(got)
    assert [r["doc_id"] for r in got] == want
    assert len(want) > 100


def test_pipeline_encode_of_any_frame(spark, library, tmp_area):
    rows = [(1, "a b"), (2, None), (None, ""), (1, "a b"), (7, "c " * 50)]
    wide = spark.createDataFrame([(d, t, 5, "x") for d, t in rows], "doc_id long, text string, position long, ids string")
    wide.coalesce(1).write.parquet(f"{tmp_area}/plain")
    import glob
    import os
    import shutil
    local = tmp_area.removeprefix("file://").removeprefix("file:")
    os.makedirs(f"{local}/given")
    for k, f in enumerate(glob.glob(f"{local}/plain/part-*.parquet")):
        shutil.copy(f, f"{local}/given/documents{k}.parquet")
    want = sorted(str((d, library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    for docs in (wide, wide.limit(0), spark.read.parquet(f"{local}/given"), spark.read.parquet(f"{local}/plain"), wide.join(wide.select("doc_id").distinct(), "doc_id", "left")):
        out = corpus_pipeline.encode(spark, docs, SF001)
        assert out.columns == ["doc_id", "n_tokens", "ids", "position"]
        got = out.collect()
        assert sorted(str((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist())) for r in got) in (want, [])
        assert len({r["position"] for r in got}) == len(got) == docs.count()


def test_pipeline_against_brute_force(spark):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.default_vocabulary())
    table = {r["doc_id"]: r for r in pq.read_table(f"{SF001}/documents.parquet").to_pylist()}
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    clean = [d for d, v in by_id(toxicity.toxicity(docs, labels), "predicted").items() if not v[0]]
    last = {}
    for d in sorted(clean):
        last[table[d]["text"]] = d
    exact = sorted(last.values())
    near = sorted(d for d, v in brute.near([(d, table[d]["text"]) for d in exact]).items() if v[2])
    kept = docs.where(docs["doc_id"].isin(near))
    copies = {r["doc_id"]: len(r["positions"]) for r in mixing.plan_mix(kept).collect()}
    want = sorted((d, library.encode(table[d]["text"], add_special_tokens=False).ids) for d in near for _ in range(copies[d]))
    got = sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in corpus_pipeline.run(spark, SF001).collect())
    assert got == want and len(got) > 50

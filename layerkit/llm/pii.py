"""Personal data (DataFrame functions only): patterns, and terms that give the found data away.

Base spans (leftmost, non-overlapping per kind): e-mail addresses, IPv4 addresses, card numbers that
pass Luhn, phone numbers. Positions are code points, end exclusive. The patterns use possessive
quantifiers and anchors that keep their meaning but make the search linear in the text.

Information-theoretic sanitisation: a found value is a protected entity, and so is each class it belongs
to: its kind, the domain of an address, the /24 network of an IP, the first six digits of a card, the first four
of a phone number. The words of a document (runs of letters, marks and digits, two or more, lower case) stand
together with all entities of the document. With frequencies over all rows,

    disclosure(word, entity) = PMI(word, entity) / IC(entity)
                             = (log N - log df(entity) + log co - log df(word)) / (log N - log df(entity)),

the share of the information about the entity that the word gives away (1: the word occurs only
where the entity does). A word with a disclosure of at least ``THRESHOLD`` is a span of kind ``term`` wherever it
stands in a document of that entity, when chance explains their meeting with a probability of at most ``ALPHA``
(Hoeffding's bound on the hypergeometric tail, :func:`_evidence`; no least number of documents: a word and a value
that share their only document meet by chance with 1 / N). One of at least ``REMOVE`` is removed by
:func:`sanitise`, a weaker one and every base span is generalised to the name of its kind.

Defined results: a null text counts as empty and has no spans; rows that repeat a doc_id are judged
each by its own text, and each counts in the statistics; spans of a kind never overlap,
and a term that overlaps a base span is left to the base span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import texts, written

KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "phone": "+"}     # without this character there is no match
ALPHA, THRESHOLD, REMOVE = 1e-3, 0.9, 0.98
WORD, OTHER = r"[\p{L}\p{M}\p{N}]++", r"[^\p{L}\p{M}\p{N}]++"
OFTEN = 100             # keys of more than 1 / OFTEN of the rows are few: their counts are broadcast
_SPAN = "struct<start:int,end:int>"
_TERMS = "array<struct<start:int,end:int,disclosure:double>>"


def _luhn(number: Column) -> Column:
    digits = F.reverse(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return found.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end): the text is split at the matches, and lengths are summed along them."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    steps = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)),
                       lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), _valid(kind, m).alias("ok")))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + s["size"]
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(s["ok"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    spans = F.aggregate(steps, first, step, lambda acc: acc["spans"])
    if kind in HINTS:
        spans = F.when(F.contains(text, F.lit(HINTS[kind])), spans).otherwise(first["spans"])
    return spans


def find_base(docs: DataFrame) -> DataFrame:
    """doc_id, text and one array of spans per base kind."""
    t = texts(docs)
    return t.select("doc_id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS[:4]])


def _entities(kind: str, text: Column, span: Column) -> Column:
    """The value of a span and its classes."""
    value = F.lower(F.substring(text, span["start"] + 1, span["end"] - span["start"]))
    digits = F.regexp_replace(value, "[^0-9]", "")
    value, group = {"email": (value, F.substring_index(value, "@", -1)), "ip": (value, F.substring_index(value, ".", 3)),
                    "card": (digits, F.substring(digits, 1, 6)), "phone": (digits, F.substring(digits, 1, 4))}[kind]
    return F.array(F.lit(f"{kind}:"), F.concat(F.lit(f"{kind}-class:"), group), F.concat(F.lit(f"{kind}:"), value))


def with_entities(base: DataFrame) -> DataFrame:
    """doc_id, row (fingerprint of the text), key (both), the base arrays, ``entities`` and, where there are any, the text."""
    text = F.col("text")
    found = F.array_distinct(F.flatten(F.concat(*[_of_kind(k, lambda kind, s: _entities(kind, text, s)) for k in KINDS[:4]])))
    row = F.xxhash64("text")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), row.cast("string"))
    return (base.select("doc_id", row.alias("row"), key.alias("key"), *KINDS[:4], found.alias("entities"), "text")
            .withColumn("text", F.when(F.size("entities") > 0, F.col("text"))))


def _words(text: Column) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _with_counts(rows: DataFrame, counts: DataFrame, key: str, df: str, least: float) -> DataFrame:
    """``rows`` joined with ``counts`` by ``key``; the few keys of ``least`` documents or more make no large task."""
    often = F.broadcast(counts.where(F.col(df) >= least))
    rest = rows.join(F.broadcast(counts.where(F.col(df) >= least).select(key).distinct()), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(counts.where(F.col(df) < least), key))


def _evidence(co: Column, drawn: Column, marked: Column, n: Column) -> Column:
    """-log of a bound on the chance that of ``drawn`` documents ``co`` or more are among ``marked`` of ``n``; 0 if
    fewer are than chance would give."""
    share, chance = co / drawn, marked / n
    none = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(F.lit(0.0))
    return F.when(share > chance, drawn * (share * F.log(share / chance) + none)).otherwise(F.lit(0.0))


def entity_rows(base: DataFrame, n: int) -> DataFrame:
    """(key, entity, copies, df_entity): the entities of each text, the rows that repeat it, the rows of the entity."""
    members = base.select("key", F.explode("entities").alias("entity")).groupBy("key", "entity").agg(F.count(F.lit(1)).alias("copies"))
    counts = written(base.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity")), "op4-entities")
    return _with_counts(members, counts, "entity", "df_entity", max(2.0, n / OFTEN))


def entity_words(base: DataFrame) -> DataFrame:
    """(key, word) of the texts that have entities."""
    found = base.where("text is not null").select("key", F.explode(_words(F.col("text"))).alias("word"))
    return found.where(F.length("word") >= 2).distinct()


def disclosing_terms(docs: DataFrame, members: DataFrame, words: DataFrame, n: int, threshold: float = THRESHOLD,
                     alpha: float = ALPHA) -> DataFrame:
    """(entity, word, df_word, disclosure) of the pairs over both bounds; statistics over all rows."""
    frequency = (texts(docs).select(F.explode(_words(F.col("text"))).alias("word")).where(F.length("word") >= 2)
                 .groupBy("word").agg(F.count(F.lit(1)).alias("df_word")))
    frequency = written(frequency, "op4-frequency")
    rows, e, w, co = F.lit(float(n)), F.col("df_entity").cast("double"), F.col("df_word").cast("double"), F.col("co").cast("double")
    counted = _with_counts(words, frequency, "word", "df_word", max(2.0, n / OFTEN))
    # they meet in df_entity rows at most: a word of more rows than this stays below the threshold
    able = (e < rows) & (w <= e * F.pow(rows / e, F.lit(1.0 - threshold)) * 1.000001)
    pairs = (counted.join(members, "key").where(able).groupBy("entity", "word")
             .agg(F.sum("copies").alias("co"), F.first("df_word").alias("df_word"), F.first("df_entity").alias("df_entity")))
    disclosure = F.log(rows * co / (e * w)) / F.log(rows / e)
    evidence = F.greatest(_evidence(co, w, e, rows), _evidence(co, e, w, rows))
    return (pairs.withColumn("disclosure", disclosure).where((F.col("disclosure") >= threshold) & (evidence >= -math.log(alpha) - 1e-9))
            .select("entity", "word", "df_word", "disclosure"))


def _term_spans(text: Column, terms: Column) -> Column:
    """(start, end, disclosure) of the words of ``text`` that ``terms`` (word -> disclosure) names: lengths are summed
    along the runs of words and others."""
    runs = F.regexp_extract_all(text, F.lit(f"{WORD}|{OTHER}"), F.lit(0))

    def step(acc: Column, run: Column) -> Column:
        end, known = acc["at"] + F.length(run), F.try_element_at(terms, F.lower(run))
        span = F.struct(acc["at"].alias("start"), end.alias("end"), known.alias("disclosure"))
        return F.struct(end.alias("at"), F.when(known.isNotNull(), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_TERMS).alias("spans"))
    return F.aggregate(runs, first, step, lambda acc: acc["spans"])


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD, alpha: float = ALPHA) -> DataFrame:
    """doc_id, row (fingerprint of the text), the four base arrays and ``term``: array of (start, end,
    disclosure). Texts are searched once for base spans and once for words."""
    base = written(with_entities(find_base(docs)), "op4-base")
    n = max(1, base.count())
    members = written(entity_rows(base, n), "op4-members")
    words = written(entity_words(base), "op4-words")
    terms = written(disclosing_terms(docs, members, words, n, threshold, alpha), "op4-terms")
    hits = (_with_counts(words, terms, "word", "df_word", max(2.0, n / OFTEN)).join(members, ["key", "entity"])
            .groupBy("key", "word").agg(F.max("disclosure").alias("disclosure"))
            .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("word", "disclosure"))).alias("terms")))
    b = base.join(hits, "key", "left")
    taken = F.concat(*[F.col(k) for k in KINDS[:4]])
    spans = F.when(F.col("terms").isNotNull(), _term_spans(F.col("text"), F.col("terms"))).otherwise(F.array().cast(_TERMS))
    free = F.filter(spans, lambda t: ~F.exists(taken, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return b.select("doc_id", "row", *KINDS[:4], free.alias("term"))


def _of_kind(kind: str, make) -> Column:
    """``make(kind, span)`` for each span of a kind."""
    return F.transform(kind, lambda span: make(kind, span))


def _joined(kinds) -> Column:
    return F.array_join(F.concat(*[_of_kind(k, lambda kind, s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])) for k in kinds]), ",")


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]],
                        F.sha2(F.encode(_joined(KINDS[:4]), "UTF-8"), 256).alias("base_sha256"),
                        _joined(KINDS).alias("spans"), F.size("term").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, found: DataFrame, remove: float = REMOVE) -> DataFrame:
    """doc_id and, for each row of ``docs``, the text with base spans generalised to ``[KIND]`` and terms removed or generalised to
    ``[TERM]`` by their disclosure. Where spans of two kinds overlap, the first that starts wins."""
    marks = F.concat(*[_of_kind(k, lambda kind, s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                            F.lit(f"[{kind.upper()}]").alias("by"))) for k in KINDS[:4]],
                     F.transform("term", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                            F.when(s["disclosure"] >= remove, "").otherwise("[TERM]").alias("by"))))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        more = F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), s["by"])
        return F.struct(F.when(fresh, s["end"]).otherwise(acc["at"]).alias("at"),
                        F.when(fresh, F.concat(acc["parts"], F.array(more))).otherwise(acc["parts"]).alias("parts"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    text = F.aggregate(F.array_sort(marks), first, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    marked = found.select(F.col("doc_id").alias("f_doc"), F.col("row").alias("f_row"), *KINDS).dropDuplicates(["f_doc", "f_row"])
    t = texts(docs)
    both = t.join(marked, F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.xxhash64("text") == F.col("f_row")))
    return both.select("doc_id", text.alias("text"))

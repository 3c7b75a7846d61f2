"""Brute-force versions of the operators, on Python lists of (doc_id, text)."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring(docs, k=50):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < d:
                gone.update(range(i, i + k))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), failed)


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets}


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)

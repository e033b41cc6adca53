"""Source divergence against plain Python."""

import random
import re
from collections import Counter, defaultdict

from evigrade.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, limit):
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = set()
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in holders[lang].items() if n >= 3]
        sources = [s for g, s in groups if g == lang]

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: shares(counts[lang, s]) for s in sources}
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, limit)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)}
    return out


def test_same_as_plain_python(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdÉéß世" for b in ("", "x", "Yy", "zz")]
    rows = []
    for i in range(150):
        own = rng.sample(words, 12)
        rows.append((rng.choice([" ", "-", "1"]).join(rng.choices(own, k=rng.randint(0, 40))), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "", None])))
    rows += [(None, "lone", "s"), ("", "lone", "t"), ("word", "two", "s"), ("1 2", "none", "s"), ("x " * 500, "en", "a")] * 2
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "text string, lang string, source string, term string, N int")
    for limit in (5, 200):
        found = [tuple(r) for r in divergence.audit_sources(docs, limit=limit).collect()]
        assert len(found) == len(set(found)) and set(found) == brute(rows, limit)


def test_stretches_cut_between_terms(monkeypatch):
    text = ("Alpha beta, " * 50).encode() + b"gamma" * 30
    whole = [w for part in divergence._words(text) for w in part]
    monkeypatch.setattr(divergence, "STRETCH", 7)
    assert [w for part in divergence._words(text) for w in part] == whole and whole[-1] == b"gamma" * 30


def test_empty_table(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "text string, lang string, source string")).collect() == []

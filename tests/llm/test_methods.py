"""Methods against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from evigrade.llm import embedding_join, fingerprints, license_scan, minhash_dedup, surrogates, toxicity
from evigrade.llm import text_kernel as tk
from evigrade.llm.label_model import fit_label_model
from evigrade.llm.packing import OpenBins
from evigrade.llm.tokens import word_tokenizer


def near_copies(seed=1, groups=6, copies=30, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            text = base[:]
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                text[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join(text))
    return texts


def brute_components(texts, width, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    up = list(range(len(texts)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_near_duplicates_equal_brute_force_in_short_and_long_lists(spark, monkeypatch):
    texts = near_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots, sizes = brute_components(texts, 3, 85)
    for longest, block in ((64, 512), (4, 8)):
        monkeypatch.setattr(minhash_dedup, "LONG_LIST", longest)
        monkeypatch.setattr(minhash_dedup, "BLOCK", block)
        rows = sorted(minhash_dedup.near_duplicates(docs, 3, 85).collect())
        assert [r.component_id for r in rows] == roots
        assert [r.n_shingles for r in rows] == sizes


def test_kernel_words_and_hashes():
    texts = ["Ab cd", "", "ab CD", None, "é x y", "  lead  trail "]
    seen = []
    for part in tk.slices(pa.array(texts, pa.string()), limit=4):
        words = tk.scan_words(part, tk.separators("space"), tk.byte_codes())
        hashes = words.hashes()
        for i in range(part.last - part.first):
            seen.append(hashes[words.first_of[i] : words.first_of[i + 1]].tolist())
    assert [len(s) for s in seen] == [2, 0, 2, 0, 2, 2]
    assert seen[0] == seen[2] and len({h for s in seen for h in s}) == 6


def test_tokens_equal_the_tokenizer():
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ours = word_tokenizer()
    rng = random.Random(3)
    pieces = ["don't", "I'LL", "naïve", "Straße", "x's", "1234", "½", "!!??", "<|endoftext|>", "İx", "Σας", "日本", "á", " ", "word", "%%%", "\t", "thaterndingha"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = OpenBins(10, 2)
    for n in (6, 8, 9):
        bins.place(n)
    assert sorted(b for b, _ in bins.rest()) == [0, 2]


def test_packing_rounds_keep_every_unit(spark, monkeypatch):
    from evigrade.llm import packing

    monkeypatch.setattr(packing, "TASK_PIECES", 50)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    units = spark.createDataFrame(list(enumerate(sizes)), "unit long, length long")
    rows = packing.best_fit(units, 100, 8).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.bin, []).append((r.offset, sizes[r.unit]))
    assert len(rows) == 400 and len(bins) <= 1.1 * sum(sizes) / 100 + 8
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 100


def test_fingerprints_merge_and_estimate():
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    parts = [" ".join(words[:2500]), " ".join(words[2496:])]
    a, b, whole = fingerprints.sketches(pa.array([*parts, " ".join(words)], pa.large_string()))
    assert fingerprints.merge(a, b).tolist() == whole.tolist()
    assert abs(fingerprints.distinct_count(whole) / 3996 - 1) < 0.3
    assert abs(fingerprints.resemblance(a, whole) - 2496 / 3996) < 0.15
    assert fingerprints.containment(a, whole) > 0.8
    assert fingerprints.decode(fingerprints.encode(a)).tolist() == a.tolist()


def test_edited_texts(spark):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice("abc def ghi jkl mno é".split()) for _ in range(rng.randint(0, 40))) for i in rng.sample(range(1000), 60)}
    rows = fingerprints.fingerprints_with_edits(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    order = sorted(texts, reverse=True)
    for row in rows:
        text, after = texts[row.doc_id], texts[order[(order.index(row.doc_id) + 1) % len(order)]]
        half = len(text) // 2
        assert row.edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    assert len(rows) == len(texts)


def test_embedding_links_equal_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", 40)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(12, size=300)] + rng.normal(scale=0.35, size=(300, 16)), rng.normal(size=(60, 16))]).astype(np.float32)
    rows = embedding_join.cosine_links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), 0.9).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    assert {r.vec_id: r.n_links for r in rows} == dict(enumerate(linked.sum(1).tolist()))
    least = np.arange(len(x))
    while True:
        now = np.minimum(least, np.where(linked, least[None, :], len(x)).min(1))
        if (now == least).all():
            break
        least = now
    assert {r.vec_id: r.component_id for r in rows} == dict(enumerate(least.tolist()))


def test_license_scan_equals_brute_force(spark):
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "ALL rights\nreserved", "GNU General Public\nLicense, version 3", "cc\nby the sea", "mit licence"]
    texts = [f"one two\n{n}\nthree four" for n in notices] + ["by cc", "rights all reserved", "x" * 50]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for row in rows:
        low = texts[row.doc_id].lower()
        words, lines = word.findall(low), low.split("\n")
        starts = [i for p, _ in license_scan.PHRASES for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        base = {label for p, label in license_scan.PHRASES for i in range(len(words)) if tuple(words[i : i + len(p)]) == p}
        more = set()
        for i in range(len(lines)):
            block = set(word.findall("\n".join(lines[i : i + 2])))
            more |= {label for label, t in license_scan.TEMPLATES if 100 * len(block & set(word.findall(t))) >= 80 * len(set(word.findall(t)))}
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
        assert (row.base_labels, row.labels) == (",".join(sorted(base)), ",".join(sorted(base | more)))


def test_surrogates_are_distinct_and_keep_their_format():
    assert len({surrogates.permute(i, 1000, "t") for i in range(1000)}) == 1000
    mails = [f"user{i}.x@mail{i % 9}.example.com" for i in range(500)]
    changed = [surrogates.surrogate("email", m) for m in mails]
    assert len(set(changed)) == 500 and all(re.fullmatch(r"[a-z]{4}\d+\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com", m) for m in changed)
    assert surrogates._luhn(surrogates.surrogate("number", "4111111111111111")) == 0
    assert surrogates.surrogate("ipv4", "192.168.1.1").startswith("192.168.")
    assert surrogates.surrogate("phone", "+1 (503) 555-8963").startswith("+1 (503) ")
    text, kinds = surrogates.rewrite("Frau Anna Schmidt, Dr. Schmidt; Ольга? password=abcdef123456", {})
    assert kinds == ["name", "name", "secret"]
    given, surname = re.match(r"Frau (\S+) ([A-Z][a-z]+), Dr\. ", text).groups()
    assert given in surrogates._GIVEN["latin", "f"] and text.count(surname) == 2 and "Schmidt" not in text


def test_collisions_take_another_attempt(spark):
    first = {}
    for i in range(100):
        name = f"{chr(65 + i % 26)}{chr(97 + i // 26)}na Roth"
        twin = first.setdefault(surrogates.surrogate("name_f", name), name)
        if twin != name:
            break
    docs = spark.createDataFrame([(f"Frau {twin} met Frau {name}",)], "text string")
    attempts, strict = surrogates.resolve_collisions(docs)
    assert len(attempts) == 1 and not strict
    text, _ = surrogates.rewrite(docs.first().text, attempts, strict)
    assert len(set(re.findall(r"Frau (\w+ \w+)", text))) == 2


def test_label_model_finds_good_voters_and_correlation():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    votes = np.stack([np.where(rng.random(20_000) < a, y, ~y) + 1 for a in (0.95, 0.85, 0.8, 0.6)], 1)
    twin = np.where(rng.random(20_000) < 0.97, votes[:, 1], 3 - votes[:, 1])
    told = np.where(rng.random(20_000) < 0.4, np.where(rng.random(20_000) < 0.97, y, ~y) + 1, 0)
    votes = np.column_stack([votes, twin, told])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(patterns, counts, label=5)
    assert any({1, 4} <= set(c) for c in model.cliques) and [5] in model.cliques
    assert model.accuracy(0) > model.accuracy(1) > model.accuracy(3)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1200):
        bad = rng.random() < 0.2
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zorkum", "zorkish", "vlimpt"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    found = toxicity.score_documents(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    ).collect()
    truth = dict(labels)
    held = [(r.score, truth[r.doc_id], r.predicted) for r in found if r.held_out]
    assert len(held) > 200 and sum(p == t for _, t, p in held) / len(held) > 0.97

"""Token alignment against plain Python over every pair of tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from evigrade.llm import alignment


def brute(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sides, found, counts = alignment.tokenizers(), [], Counter()

    def spans(side, ids):
        at, out = 0, []
        for number in ids:
            out.append((at, at + len(side.bytes[number]), number))
            at = out[-1][1]
        return out

    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if any(b"".join(side.bytes[i] for i in ids) != whole for side, ids in zip(sides, (a, b))):
            a, b = [], []
        sa, sb = spans(sides[0], a), spans(sides[1], b)
        links = [(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in sa} & {y[1] for y in sb})
        groups, low = [], 0
        for high in ends:
            groups.append("|".join(",".join(str(n) for lo, hi, n in side if low <= lo and hi <= high) for side in (sa, sb)))
            low = high
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        (
            doc_id or 0, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, n_groups, links, text in found
    )


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def texts():
    rng = random.Random(5)
    words = ["hello", "World", "straße", "naïve", "привет", "世界", "🙂", "é", "12345", "<|endoftext|>", "<s>", "<0x41>", "a▁b", "can't", "  ", "\n\n", "\t", "\x00", "\u0085", "x" * 40]
    rows = [(i, rng.choice([" ", "", "\n"]).join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " "), (None, "null id"), (3, "repeated id"), (3, "repeated id"), (204, " leading and trailing ")]
    return rows


def test_same_as_every_pair_of_tokens(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, Pairs int").repartition(3)
    found = alignment.align_tokenizers(docs).collect()
    assert sorted((r.doc_id or 0, *(r[c] for c in COLUMNS)) for r in found) == brute(rows)


@pytest.mark.parametrize("size", [7, 50])
def test_small_stretches_and_blocks_give_the_same(spark, monkeypatch, size):
    rows = texts()[:40]
    one = alignment.Aligner()
    whole = {}
    for i, text in rows:
        a, b = one.encode(text)
        if len(a):
            whole[i] = [*one.align([(a, b)])][0]
    monkeypatch.setattr(alignment, "STRETCH", size)
    for i, text in rows:
        a, b = one.encode(text)
        if len(a):
            parts = list(one.align(list(one.parts(a, b))))
            assert ";".join(p[0] for p in parts) == whole[i][0] and sum(p[1] for p in parts) == whole[i][1]
            keys, merged = Counter(), Counter()
            for p in parts:
                merged.update(dict(zip(p[2].tolist(), p[3].tolist())))
            keys.update(dict(zip(whole[i][2].tolist(), whole[i][3].tolist())))
            assert merged == keys


def test_empty_table(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = alignment.align_tokenizers(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_quick_and_whole_tokenizers_agree():
    both = alignment.tokenizers()[0]
    rng = random.Random(2)
    letters = [chr(c) for c in [*range(0x20, 0x7F), 9, 10, 13, *range(0xA1, 0x2B0), *range(0x400, 0x530), *range(0x2010, 0x2028)]]
    for _ in range(300):
        text = "".join(rng.choices(letters, k=rng.randint(1, 60)))
        assert both.quick.encode_ordinary(text) == both.whole.encode(text, add_special_tokens=False).ids


def test_a_stretch_asks_for_its_links_only():
    one, asked = alignment.Aligner(), []

    class Seen:
        def __init__(self, db):
            self.db = db

        def sql(self, text):
            asked.append(text)
            return self.db.sql(text)

        def __getattr__(self, name):
            return getattr(self.db, name)

    one.db = Seen(one.db)
    a, b = one.encode("two words and more")
    text, groups, _, counts = [*one.align([(a, b)])][0]
    assert asked == [alignment._PAIRS] and groups == text.count(";") + 1 and counts.sum() >= max(len(a), len(b))

"""Registered queries on the smallest tables, held against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from evigrade.llm import queries, surrogates
from evigrade.session import load

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts(spark, tokenizer):
    docs = load(spark, SMALL, "documents").collect()
    wanted = Counter()
    for r in docs:
        text = r.text or ""
        ids = len(tokenizer.encode(text, add_special_tokens=False).ids)
        words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        for version, n in (("word_bpe_49k@1", ids), ("white_space@1", words), ("word_bpe_49k@2", ids)):
            for measure, amount in (("docs", 1), ("tokens", n), ("chars", len(text))):
                wanted[r.source, r.lang, version, measure] += amount
    rows = queries.op5_token_counts(spark, SMALL).collect()
    found = {(r.source, r.lang, r.tokenizer, m): r[m] for r in rows for m in ("docs", "tokens", "chars")}
    assert {k: n for k, n in found.items() if n} == {k: n for k, n in wanted.items() if n}
    assert not any(r.tokenizer == "trial@1" for r in rows)


def test_packed_pieces(spark, tokenizer):
    texts = {r.doc_id: r.text or "" for r in load(spark, SMALL, "documents").collect()}
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in queries.op3_best_fit_packing(spark, SMALL).collect():
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_doc) == sorted(texts)
    total = 0
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for i, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            part = ids[2048 * i : 2048 * (i + 1)]
            assert (p.piece, p.start, p.length, p.ids_crc32) == (i, 2048 * i, len(part), zlib.crc32(part.tobytes()))
        assert len(pieces) == -(-len(ids) // 2048)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * total / 2048 + 2


def test_no_surrogate_is_real_and_distinct_stays_distinct(spark):
    found = surrogates.find_entities(load(spark, LARGER, "documents")).select("kind", "entity").distinct().collect()
    attempts = surrogates.resolve_collisions(load(spark, LARGER, "documents"))[0]
    real, made = {r.entity for r in found}, defaultdict(set)
    for kind, entity in found:
        surname = attempts.get(("surname", entity.rpartition(" ")[2]), 0) if kind.startswith("name_") else 0
        whole = kind.startswith("name_") and " " not in entity
        made[surrogates.surrogate("surname" if whole else kind, entity, surname if whole else attempts.get((kind, entity), 0), False, surname)].add(entity)
    assert len(found) > 50 and not real & set(made)
    assert all(len(entities) == 1 for entities in made.values())


def test_shards_against_the_law(spark):
    texts = {r.doc_id: r.text or "" for r in load(spark, SMALL, "documents").collect()}
    rows = queries.op9_balanced_sharding(spark, SMALL).collect()
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert len(rows) == len(texts) and set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # a group larger than a shard must be cut, any other stays whole
    most = -(-len(texts) // 16)
    sizes = Counter(texts.values())
    assert all(len(shards) == 1 for text, shards in groups.items() if sizes[text] <= most // 2)

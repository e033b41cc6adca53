"""Every operator on an odd table: nulls, empty and long texts, repeated rows, clashing extra columns; and on an empty one."""

import pytest
from pyspark.sql import functions as F

from evigrade.llm import embedding_join, fingerprints, license_scan, minhash_dedup, mixing, packing, rollups, sharding, surrogates, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, shard int, size long"
LONG = "alpha beta gamma delta " * 5000
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 1, 0.5, 9, 1, 1),
    (2, "", "en", "s1", 0, 0.5, 9, 1, 1),
    (3, None, None, None, None, None, None, None, None),
    (4, LONG, "en", "s2", 1, 0.5, 9, 1, 1),
    (5, LONG, "en", "s2", 1, 0.5, 9, 1, 1),
    (5, LONG, "en", "s2", 1, 0.5, 9, 1, 1),
    (None, "null id text with mail a.b@x.example.com", "de", "s3", 1, 0.5, 9, 1, 1),
    (7, "ALPHA beta gamma delta epsilon zeta", "en", None, 1, 0.5, 9, 1, 1),
    (8, " \t\n ", "en", "s1", 1, 0.5, 9, 1, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1, "x"), (4, 1, 0, "x"), (5, None, 1, "x"), (None, 1, 1, "x")], "doc_id long, toxic int, quality int, text string")


def vectors(spark, empty=False):
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (3, [0.0, 0.0], "a"), (4, None, "a"), (5, [1.0, None], "a"),
            (6, [float("nan"), 1.0], "a"), (7, [0.0, 1.0], "a"), (None, [0.0, 3.0], "a"), (9, [1.0, 0.0, 0.0], "a"), (7, [0.0, 1.0], "a"), (11, [], "a")]
    return spark.createDataFrame([] if empty else rows, "vec_id long, embedding array<float>, cell string")


def test_toxicity(docs, labels):
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_pii(docs):
    rows = surrogates.replace_pii(docs).collect()
    assert len(rows) == len(ROWS)
    found = [r for r in rows if r.n_entities]
    assert len(found) == 1 and found[0].doc_id is None and "a.b@x" not in found[0].text
    assert [r.text for r in rows if r.doc_id == 3] == [None]


def test_packing(docs):
    rows = packing.pack_documents(docs).collect()
    assert {r.length for r in rows if r.doc_id in (2, 3, 8)} == {1}
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_fingerprints(docs):
    rows = fingerprints.fingerprints_with_edits(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3, 8)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id in (4, 5)}) == 1


def test_rollups(spark, docs, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    assert store.totals().count() == 0
    counts = rollups.count_documents(docs)
    assert store.commit("1", rollups.inserts(counts, "v", "words")) and not store.commit("1", rollups.inserts(counts, "v", "words"))
    totals = {(r.source, r.lang): (r.docs, r.tokens) for r in store.totals().collect()}
    assert totals["s2", "en"] == (3, 60000) and totals[None, None] == (1, 0)
    store.commit("2", rollups.revisions(counts, "v", "words", "chars"))
    store.commit("3", rollups.deletes(counts, "v", "chars"))
    assert store.totals().count() == 0


def test_embeddings(spark):
    rows = sorted(embedding_join.cosine_links(vectors(spark), 0.9).collect(), key=lambda r: (r.vec_id or 0, r.n_links))
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows]
    assert found == [
        (None, 2, 7, False), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (7, 2, 7, True), (7, 2, 7, True), (9, 0, 9, True), (11, 0, 11, True),
    ]


def test_licenses(docs):
    rows = license_scan.scan_licenses(docs).collect()
    assert len(rows) == len(ROWS) and all(r.labels == "" and r.score == 0 and r.first_word is None for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 8)} == {0}


def test_near_duplicates(docs):
    rows = minhash_dedup.near_duplicates(docs, 3, 85).collect()
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None)
    assert found == [(1, 4, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 4, 4, True), (5, 4, 4, False), (5, 4, 4, False), (7, 4, 1, False), (8, 0, 8, True)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


def test_sharding(docs):
    rows = sharding.balanced_shards(docs, 4).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(4)]
    assert sum(sizes) == len(ROWS) and max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_mixing(docs):
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


def test_empty_tables(spark, docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    assert toxicity.score_documents(none, no_labels).count() == 0
    assert surrogates.replace_pii(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert fingerprints.fingerprints_with_edits(none).count() == 0
    assert embedding_join.cosine_links(vectors(spark, True), 0.9).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    assert minhash_dedup.near_duplicates(none).count() == 0
    assert sharding.balanced_shards(none).count() == 0
    assert mixing.mix_plan(none).count() == 0


def test_cosine_links_at_any_scale(spark):
    rows = [
        (1, [1e-200, 0.0]), (2, [1e-4, 1.0]), (3, [1.0, 0.0]), (4, [1e200, 1e200]), (5, [2e200, 2.00001e200]),
        (6, [5e-324, 0.0]), (7, [0.0, -1e308]), (8, [0.0, -1.7e308]), (9, [float("inf"), 1.0]), (10, [0.0, 0.0]), (11, None),
        (12, [None, 1.0]), (13, [1.0]),
    ]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.cosine_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {
        1: (2, 1), 3: (2, 1), 6: (2, 1), 2: (0, 2), 4: (1, 4), 5: (1, 4), 7: (1, 7), 8: (1, 7), 9: (0, 9), 10: (0, 10), 11: (0, 11),
        12: (0, 12), 13: (0, 13),
    }

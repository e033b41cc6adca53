"""Cases that were once missed: repeated ids, lost links, clashing columns, compaction, deletes."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evigrade.llm import fingerprints, label_model, minhash_dedup, mixing, rollups, skew, surrogates, toxicity
from tests.llm.test_methods import brute_components, near_copies


def test_rows_that_repeat_an_id_keep_all_their_links(spark):
    words = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    texts = [(5, " ".join(words)), (5, " ".join(other)), (6, " ".join(words[:-1] + ["x"])), (7, " ".join(other[:-1] + ["y"])), (8, "alone here")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = minhash_dedup.near_duplicates(docs, 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(5, 5), (5, 5), (6, 5), (7, 5), (8, 8)]
    kept = minhash_dedup.drop_near_duplicates(docs, 3, 85).collect()
    assert sorted((r.doc_id, r.text[:2]) for r in kept) == [(5, "v0"), (5, "w0"), (8, "al")]


def test_dropping_keeps_one_of_equal_rows_and_any_columns(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "A b c d e f", "z"), (2, "", "p"), (2, "", "q"), (3, None, "r"), (None, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_id string").withColumnsRenamed({"own_id": "Own_Id"})
    kept = minhash_dedup.drop_near_duplicates(docs).collect()
    assert Counter(r.text for r in kept) == {"a b c d e f": 1, "": 2, None: 2}


def test_posted_values_meet_every_linked_set():
    rng = random.Random(1)
    for percent in (80, 85):
        for _ in range(400):
            n = rng.choice([1, 2, 3, 7, 20, 60, 150, 400])
            a = rng.sample(range(10**6), n)
            worst = int(n * (100 - percent) / (100 + percent))
            b = a[: n - rng.randint(0, worst)]
            b += rng.sample(range(10**6, 2 * 10**6), rng.randint(0, max(0, worst - (n - len(b)))))
            both = len(set(a) & set(b))
            if 100 * both < percent * (len(a) + len(b) - both):
                continue
            everywhere = Counter({v: rng.randint(2, 9) for v in [*a, *b]})
            posts = []
            for s in (a, b):
                sketch = sorted(s)[: minhash_dedup.retained(len(s), percent)]
                n_posts, meets = minhash_dedup.posted(len(s), percent)
                posts.append((set(sorted(sketch, key=lambda v: (everywhere[v], v))[:n_posts]), meets))
            (p, x), (q, y) = posts
            assert len(p & q) >= min(x, y) >= 1


@pytest.mark.parametrize("words", [9, 300])
def test_large_clusters_equal_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(minhash_dedup, "LONG_LIST", 4)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    texts = near_copies(3, 4, 25, words) + ["same text of one group here"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    roots, _ = brute_components(texts, 3, 85)
    assert [r.component_id for r in sorted(minhash_dedup.near_duplicates(docs, 3, 85).collect())] == roots


def test_salted_join_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    rows = spark.createDataFrame([(i, 0 if i % 2 else i) for i in range(400)] + [(400, None)], "a long, k long")
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 400, 4)], "k long, v long")
    found = skew.salted_join(rows, table, ["k"], ["a"]).collect()
    assert sorted((r.a, r.v) for r in found) == sorted((i, 0 if i % 2 else 10 * i) for i in range(400) if i % 2 or i % 4 == 0)


def test_stages_keep_columns_that_clash(spark):
    rows = [(i, f"word{i} fine text number {i}", "s", i, "k", 7) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, row_key string, _doc int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert mixing.mix_documents(docs).columns == docs.columns
    assert {r.row_key for r in toxicity.drop_toxic(docs, labels, 2.0).collect()} == {"k"}
    assert surrogates.replace_pii(docs).columns[:6] == docs.columns


def test_empty_tables_in_the_stages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == 0
    assert minhash_dedup.drop_near_duplicates(docs).count() == 0
    assert mixing.mix_documents(docs).count() == 0
    assert rollups.count_documents(docs).count() == 0


def test_compaction_and_deletes_change_no_total(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"a b {'c ' * (i % 3)}", "s", "en") for i in range(30)], "doc_id long, text string, source string, lang string")
    counts = rollups.count_documents(docs)
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    assert store.commit("1", rollups.inserts(counts, "v1", "words")) and store.commit("2", rollups.inserts(counts, "v2", "tokens"))
    before = sorted(map(tuple, store.totals().collect()))
    assert store.compact() == 2 and store.committed() == ["1", "2"] and store.compact() == 0
    assert not store.commit("1", rollups.inserts(counts, "v1", "words"))
    assert sorted(map(tuple, store.totals().collect())) == before
    store.commit("3", rollups.deletes(counts, "v2", "tokens"))
    assert store.compact() == 2
    assert [(r.tokenizer, r.docs) for r in store.totals().collect()] == [("v1", 30)]


def test_a_second_committer_of_a_batch_changes_nothing(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    row = spark.createDataFrame([("s", "en", "v", 1, 2, 3)], rollups._SCHEMA)
    row.write.parquet(f"{store.path}/_private-x")
    row.write.parquet(f"{store.path}/_private-y")
    assert store._publish(f"{store.path}/_private-x", "batch-1") and not store._publish(f"{store.path}/_private-y", "batch-1")
    assert [r.docs for r in store.totals().collect()] == [1]


def test_fingerprints_in_many_ranges_with_null_and_equal_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 40)
    rng = random.Random(8)
    rows = [(rng.choice([None, 7, 7, *range(40)]), " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 12)))) for _ in range(200)]
    found = fingerprints.fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    one = {i: t for i, t in rows if Counter(x for x, _ in rows)[i] == 1}
    assert {r.doc_id: r.n_chars for r in found if r.doc_id in one} == {i: len(t) for i, t in one.items()}


def test_near_next_estimates_true_resemblance(spark):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(900)]
    texts = {i: " ".join(base[rng.randrange(200) : 600 + rng.randrange(300)]) for i in range(12)}
    found = {r.doc_id: r.near_next for r in fingerprints.fingerprints_with_edits(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i in range(12):
        sets = []
        for text in (texts[i], texts[(i - 1) % 12]):
            words = text.split()
            sets.append({tuple(words[j : j + 5]) for j in range(len(words) - 4)})
        assert abs(found[i] - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.2


def test_mined_features_reach_toxic_rows(spark):
    rows = [(r, 1.0, f) for r in range(30) for f in (1, 2 + r % 2)] + [(100 + r, 0.0, 4) for r in range(50)] + [(r, 1.0, 4) for r in range(5)]
    taken = toxicity.cover(spark.createDataFrame(rows, "row long, toxic double, feature int"))
    assert 1 in taken and 4 not in taken and set(taken) <= {1, 2, 3}


def test_few_labels_still_anchor_the_label_model():
    votes = [[2, 2, 2], [1, 1, 1], [2, 0, 0], [1, 0, 0]]
    model = label_model.fit_label_model(votes, [20, 40, 300, 900], label=2)
    clean, toxic = model.posterior(__import__("numpy").array([[1, 1, 0], [2, 2, 0]]))
    assert toxic > 0.5 > clean


def test_groups_of_equal_texts_stay_whole_on_a_real_table(spark):
    from evigrade.llm import sharding
    from evigrade.session import load

    docs = load(spark, "/root/testdata/sf0.01", "documents")
    found = defaultdict(set)
    for r in sharding.balanced_shards(docs).join(docs.select("doc_id", F.md5("text").alias("key")), "doc_id").collect():
        found[r.key].add(r.shard)
    assert all(len(shards) == 1 for shards in found.values())


def test_untitled_mentions_of_a_name_follow_it(spark):
    text = "Mr John Smith met Mrs Anna Smith. Later John Smith and Smith went; Smithers stayed. Smith, a.b@smith.example.com"
    docs = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, _late string, own_key string")
    row = surrogates.replace_pii(docs).first()
    assert "Smith " not in row.text and "John" not in row.text and "Smithers" in row.text and (row._late, row.own_key) == ("x", "y")
    full, surname = __import__("re").match(r"Mr (\w+ (\w+)) met", row.text).groups()
    assert row.text.count(full) == 2 and row.text.count(surname) == 5


@pytest.mark.parametrize("smaller_first", [True, False])
def test_overlapping_compactions_count_a_batch_once(spark, tmp_path, smaller_first):
    """Two compactions publish {1, 2} and {1, 2, 3}, in either order of names."""
    schema = "source string, lang string, tokenizer string, docs long, tokens long, chars long"
    store = rollups.RollupStore(spark, str(tmp_path / "store"))
    for batch in (1, 2, 3):
        assert store.commit(str(batch), spark.createDataFrame([("s", "l", "t", batch, 10 * batch, 0)], schema))
    low, high = ("folded-a", "folded-b") if smaller_first else ("folded-b", "folded-a")
    for name, batches in ((low, [1, 2]), (high, [1, 2, 3])):
        total = sum(batches)
        spark.createDataFrame([("s", "l", "t", total, 10 * total, 0)], schema).write.parquet(f"{store.path}/{name}/deltas")
        spark.createDataFrame([(str(b),) for b in batches], "batch string").write.parquet(f"{store.path}/{name}/names")
    assert store.committed() == ["1", "2", "3"] and store.totals().first()["docs"] == 6
    assert not store.commit("2", spark.createDataFrame([], schema))
    assert store.commit("4", spark.createDataFrame([("s", "l", "t", 4, 40, 0)], schema))
    assert store.compact() == 2
    assert store.totals().first()["docs"] == 10 and store.committed() == ["1", "2", "3", "4"]
    assert len([p for p in (tmp_path / "store").iterdir() if p.is_dir()]) == 1

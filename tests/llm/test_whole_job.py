"""Each operator does all of its job: inputs on which a cap, a sample or a missing step shows."""

import hashlib
import random
import re
import textwrap
from collections import Counter, defaultdict

import duckdb
import pytest

from evigrade.llm import license_scan, mixing, queries, sharding, surrogates


def shards_by_text(spark, texts, shards=16):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sharding.balanced_shards(docs, shards).collect()
    loads = Counter(r.shard for r in rows)
    assert len(rows) == len(texts) and max(loads.values()) - min(loads.values()) <= 1
    found = defaultdict(Counter)
    for r in rows:
        found[texts[r.doc_id]][r.shard] += 1
    return found


def test_sharding_cuts_no_pair_when_every_row_is_linked(spark):
    found = shards_by_text(spark, [f"text {i // 2}" for i in range(640)])
    assert sum(len(shards) > 1 for shards in found.values()) == 0


def test_sharding_spreads_a_large_group_over_as_few_shards_as_hold_it(spark):
    found = shards_by_text(spark, ["hot"] * 320 + [f"text {i // 2}" for i in range(320)] + [f"own {i}" for i in range(320)])
    assert len(found["hot"]) == 6
    assert sum(len(shards) > 1 for shards in found.values()) == 1


def test_propagation_swaps_between_full_shards(spark):
    rows = [(i, i // 2, (i * 7 + i // 16) % 4) for i in range(400)]
    before = Counter(shard for _, _, shard in rows)
    capacity = [before[s] for s in range(4)]
    linked = spark.createDataFrame(rows, "row long, edge long, shard int")
    after = sharding.propagate(linked, capacity).collect()
    loads = Counter(r.shard for r in after)
    assert all(loads[s] <= capacity[s] for s in range(4)) and len(after) == 400
    cut_before = 200 - sum(rows[i][2] == rows[i + 1][2] for i in range(0, 400, 2))
    of = {r.row: r.shard for r in after}
    cut_after = sum(of[i] != of[i + 1] for i in range(0, 400, 2))
    assert cut_before > 100 and cut_after <= 6


def test_flows_pass_rings_and_freed_room():
    assert sharding.flows({(0, 1): 3, (1, 2): 3, (2, 0): 2}, [0, 0, 0]) == {(0, 1): 2, (1, 2): 2, (2, 0): 2}
    assert sharding.flows({(0, 1): 5, (1, 2): 4}, [0, 0, 2]) == {(1, 2): 2, (0, 1): 2}


def due(share, knots):
    """When a piecewise linear schedule has used a share of its area, by bisection."""

    def used(time):
        area = 0.0
        for (a, u), (b, v) in zip(knots, knots[1:]):
            end = min(max(time, a), b)
            area += (end - a) * (u + u + (v - u) * (end - a) / (b - a)) / 2
        return area

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if used(middle) < share * used(1.0) else (low, middle)
    return low


def test_mixing_positions_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = {r.doc_id: r for r in mixing.mix_positions(docs).collect()}
    assert len(found) == 300
    order = []
    names = sorted({s for _, _, s in rows if s}) + [None]
    for kind, name in enumerate(names):
        own = sorted((r for r in rows if r[2] == name), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
        wanted, begins = int(found[own[0][0]].target + 0.5), 0
        for copy in range(2):
            for i, text, _ in own:
                words = min(max(wanted - begins, 0), len(text.split()))
                if words:
                    order.append((due(begins / wanted, mixing.SCHEDULES[kind % 3]), kind, copy, i, words))
                begins += len(text.split())
    got = sorted((t.position, r.doc_id, t.copy, t.words, t.time) for r in found.values() for t in r.takes)
    assert [g[0] for g in got] == list(range(len(order)))
    assert sorted(g[1:4] for g in got) == sorted((i, copy, words) for _, _, copy, i, words in order)
    times = {(i, copy): time for time, _, copy, i, _ in order}
    assert all(abs(times[i, copy] - time) < 1e-9 for _, i, copy, _, time in got)
    assert [g[4] for g in got] == sorted(g[4] for g in got)


def test_mixing_keeps_the_rows_of_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    asked = db.sql(queries.ORACLES["op10_source_mixing"])
    found = queries.op10_source_mixing(spark, folder)
    assert sorted(found.columns) == sorted(asked.columns)
    assert sorted(map(tuple, found.select(*asked.columns).collect())) == sorted(asked.fetchall())


def test_mixed_documents_come_in_the_order_of_their_positions(spark):
    rng = random.Random(9)
    rows = [(i % 50, " ".join(f"w{i}" for _ in range(rng.randint(0, 9))), rng.choice(["a", "a", "b", None]), 0, i) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, _doc int").repartition(4)
    got = mixing.mix_documents(docs).collect()
    assert got and [c for c in got[0].__fields__] == docs.columns and all(r.n_chars == len(r.text) for r in got)
    plan = mixing.mix_positions(docs).collect()
    assert sum(r.taken for r in plan) == sum(len(r.text.split()) for r in got)
    wanted = sorted((t.position, r.doc_id, t.words) for r in plan for t in r.takes)
    # rows that repeat a doc_id at one time and copy may swap
    assert [(i, n) for _, i, n in wanted] == [(r.doc_id, len(r.text.split())) for r in got]


def test_names_beyond_the_pool_stay_distinct(spark):
    names = [f"{chr(65 + i)}{c}nar Smith" for i in range(20) for c in "ae"]
    texts = [f"Mr {n} met Mrs Smith" for n in names] + ["Mr Smith and Mrs Smith", "Κύριος Νίκος Παπας", "Frau Li", "Frau Anna Li"]
    rows = surrogates.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    done = {r.doc_id: r.text for r in rows}
    found = [re.match(r"Mr (\w+ \w+) met Mrs (\w+)", done[i]).groups() for i in range(40)]
    surname = found[0][1]
    assert len({name for name, _ in found}) == 40 and not {name for name, _ in found} & set(names)
    assert {name.split()[1] for name, _ in found} | {lone for _, lone in found} == {surname}
    assert sum(name.split()[0] in surrogates._GIVEN["latin", "m"] for name, _ in found) == 12
    assert done[40] == f"Mr {surname} and Mrs {surname}"
    assert done[43].split()[-1] == done[42].split()[-1]


def test_surrogates_avoid_real_values_of_a_crowded_format(spark):
    names = [a + b for a in "ABCDEFGHIJKLM" for b in "abcdefghijklmnopqrstuvwx"]
    rows = surrogates.replace_pii(spark.createDataFrame([(i, f"Mr {n}") for i, n in enumerate(names)], "doc_id long, text string")).collect()
    found = {r.text[3:] for r in rows}
    assert len(found) == len(names) and not found & set(names)


def test_a_format_without_free_values_raises(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "STUCK", 2)
    names = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrstuvwxyz"]
    with pytest.raises(RuntimeError, match="no free surrogate"):
        surrogates.replace_pii(spark.createDataFrame([(i, f"Mr {n}") for i, n in enumerate(names)], "doc_id long, text string"))


def test_wrapped_and_spaced_notices_are_found(spark):
    rows, wanted = [], []
    for label, template in license_scan.TEMPLATES:
        for columns in (20, 30, 40, 50):
            for between in ("\n", "\n\n", "\r\n \r\n", "\n# "):
                rows.append((len(rows), "first line\nsecond: " + between.join(textwrap.wrap(template, columns)) + " end\nlast line"))
                wanted.append(label)
    rows.append((len(rows), "mit\n" + "other words here\n" * 9 + "license"))
    found = {r.doc_id: r.labels.split(",") for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, label in enumerate(wanted) if label not in found[i]] == []
    assert found[len(wanted)] == [""]


def test_propagation_gathers_families_of_different_texts(spark):
    """Families of near copies, dealt apart at first: rounds move them together, and counts stay even."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for family in range(60):
        base = rng.choices(words, k=60)
        for member in range(5):
            texts.append(" ".join([*base, f"end{family}_{member}"]))
    texts += [" ".join(rng.choices(words, k=40)) for _ in range(100)]
    texts += texts[:40]  # equal texts: nodes of weight 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    trace = []
    rows = sharding.balanced_shards(docs, 8, trace=trace).collect()
    loads = Counter(r.shard for r in rows)
    assert sum(loads.values()) == len(texts) and max(loads.values()) - min(loads.values()) <= 1
    assert sum(t["moves"] for t in trace) > 0 and min(t["cut"] for t in trace) < trace[0]["cut"] / 3
    shard_of = defaultdict(set)
    for r in rows:
        shard_of[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())

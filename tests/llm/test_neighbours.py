"""Nearest neighbours against brute force, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from evigrade.llm import neighbours
from evigrade.session import load


def test_recall_on_the_sample_table(spark):
    table = load(spark, "/root/testdata/sf0.01", "embeddings")
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    hits, near = 0, {}
    for r in found:
        near.setdefault(r.query_id, []).append(r)
    queries = [i for i, v in enumerate(ids) if v % 20 == 0]
    assert sorted(near) == sorted(ids[queries].tolist())
    for q in queries:
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(ids[np.argsort(-scores, kind="stable")[:20]].tolist())
        mine = sorted(near[ids[q]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21)) and ids[q] not in [r.vec_id for r in mine]
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - scores[list(ids).index(r.vec_id)]) < 1e-12 for r in mine)
        hits += len(best & {r.vec_id for r in mine})
    assert hits >= 0.9 * 20 * len(queries)


def test_ties_unsound_vectors_and_repeats(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100, 130)] + [(20, [1.0, 0.0]), (40, [0.0, -3.0]), (60, None), (80, [0.0, 0.0]), (7, [float("nan"), 1.0])]
    rows += [(9, [None, 1.0]), (11, [float("inf"), 0.0]), (13, [5.0]), (20, [2.0, 0.0]), (None, [0.5, 0.5])]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, uid int, Score string")
    found = neighbours.nearest(vectors, F.col("vec_id").isin(20, 40, 60, 80), 3).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    assert got == sorted(
        [(20, 1, 20, 2.0), (20, 2, 100, 1.0), (20, 3, 101, 1.0), (20, 1, 20, 2.0), (20, 2, 100, 2.0), (20, 3, 101, 2.0)]
        + [(40, 1, 20, 0.0), (40, 2, 20, 0.0), (40, 3, 100, 0.0)]
    )


def test_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(20, [1.0])], schema), F.lit(True)).collect() == []

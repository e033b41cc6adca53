"""The pipeline's stages, each on what the one before kept."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from evigrade.session import load

#: With nine toxic labels the smallest tables teach nothing; these have 37 in training rows.
FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = load(spark, FOLDER, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = (before, docs)
    before, after = kept["toxicity"]
    gone = before.join(after, "doc_id", "left_anti")
    assert 0 < gone.count() < 0.2 * before.count()
    before, after = kept["near_dedup"]
    assert after.join(before, list(corpus_pipeline.COLUMNS), "left_semi").count() == after.count() < before.count()
    assert after.where("text <> ''").groupBy("text").count().where("count > 1").isEmpty()
    before, after = kept["pii"]
    assert after.count() == before.count()
    old = {m for r in before.collect() for m in re.findall(r"\S+@\S+\.com", r.text)}
    assert old and not any(m in r.text for r in after.collect() for m in old)
    before, after = kept["mixing"]
    words = lambda df: df.agg(F.sum(F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")))).first()[0]
    assert abs(words(after) - 1.5 * words(before)) < 50
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.agg(F.count_distinct("doc_id")).first()[0] == docs.select("doc_id").distinct().count()


def test_stages_compose_without_tables_between(spark):
    docs = load(spark, FOLDER, "documents")
    clean = corpus_pipeline.toxicity(spark, docs, FOLDER)
    several = corpus_pipeline.near_dedup(spark, clean, FOLDER)
    other = corpus_pipeline.toxicity(spark, docs, FOLDER)
    assert 0 < several.count() < clean.count() == other.count()


def test_stages_on_empty_tables_nulls_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "one two three", None, "b", 13), (2, "one two three", None, "b", 13)]
    docs = spark.createDataFrame(rows, schema).withColumns({"_score": F.lit("x"), "key": F.lit(1), "Shard": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == list(corpus_pipeline.COLUMNS)
        assert found.where("text is null").count() == (0 if name == "mixing" else 1)
    packed = corpus_pipeline.packing(spark, docs, FOLDER)
    assert packed.agg(F.count_distinct("doc_id")).first()[0] >= 2

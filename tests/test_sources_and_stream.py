"""CSV, artifact folders, evidence cells and the result stream."""

from pyspark.sql import functions as F

from evigrade.sources import artifacts, batch_csv, evidence
from evigrade.streaming import results


def test_batch_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿input_id,main_text\n1,"two\nlines ""quoted"""\n2,\n', encoding="utf-8")
    rows = batch_csv.read_batch_csv(spark, str(path)).orderBy("row_number").collect()
    assert [(r.input_id, r.main_text, r.row_number) for r in rows] == [("1", 'two\nlines "quoted"', 1), ("2", "", 2)]


def test_missing_output_means_nothing_done(spark, tmp_path):
    assert batch_csv.completed_ids(spark, str(tmp_path / "none")).count() == 0


def test_artifact_scan(spark, tmp_path):
    folder = tmp_path / "run" / "a1" / "retailer"
    folder.mkdir(parents=True)
    (folder / "vision.md").write_text("seen")
    (folder.parent / "request.json").write_text("{}")
    rows = {(r.scrape_id, r.rel_path, r.text) for r in artifacts.scan_artifacts(spark, str(tmp_path / "run")).collect()}
    assert rows == {("a1", "retailer/vision.md", "seen"), ("a1", "request.json", "{}")}


def test_evidence_cells(spark):
    cells = spark.createDataFrame([('{"items":[{"title":"t"}]}',), ('{"title":"u"}',), ('[{"title":"v"}]',), ("plain",), ("",)], "c string")
    found = [[(i.title, i.text) for i in r[0]] for r in cells.select(evidence.evidence_items("c")).collect()]
    assert found == [[("t", None)], [("u", None)], [("v", None)], [(None, "plain")], []]


def test_stream_grades_each_id_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "input_id string, n int")
    rows.write.parquet(str(tmp_path / "in"))
    stream = results.request_stream(spark, str(tmp_path / "in"), rows.schema)
    out = str(tmp_path / "out")
    results.write_results(stream, lambda b: b.withColumn("graded", F.lit(True)), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.input_id for r in spark.read.parquet(out).collect()) == ["a", "b"]

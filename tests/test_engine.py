"""From a batch file to its output, and what stands between."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from evigrade import Batch, Settings
from evigrade.__main__ import main
from evigrade.config import accept_language, proxy_url
from evigrade.engine import grade
from evigrade.functions import html as H
from evigrade.functions import text as T
from evigrade.functions import vocab
from evigrade.operators import batch, capture, images
from evigrade.session import apply_semantics
from evigrade.sources import sinks

CAPTURES = (
    "scrape_id string, ordinal int, fetch_profile string, url string, final_url string, title string, description string, canonical_url string,"
    " raw_markdown string, raw_html string, access_status string, access_issue_type string, success boolean, proxy_used boolean,"
    " json_ld array<string>, og map<string,string>, product_meta map<string,string>,"
    " tables array<struct<index:int,caption:string,n_rows:int,n_columns:int,markdown:string>>, n_images int"
)
IMAGES = "scrape_id string, ordinal int, local_path string, alt string, relevance string, description string, download_source string, error string"


def captures(spark):
    rich = "brand Acme product price material age details features description ean 4000000000017 wooden puzzle horse " * 200
    rows = []
    for scrape_id in ("a", "a__DUP02", "b"):
        good = scrape_id != "b"
        for ordinal, profile in enumerate(("standard", "load_wait")):
            text = rich if good and ordinal else "captcha robot check"
            rows.append((scrape_id, ordinal, profile, f"https://s.example.com/p/{scrape_id}", "", "Wooden horse" if good else "", "", "", text, "<p>", "accessible", "none", True,
                         False, ["{}"] if good else [], {}, {"product:brand": "Acme"} if good else {}, [(1, "Facts", 1, 1, "| a |")] if good else [], 5))
    return spark.createDataFrame(rows, CAPTURES)


def batch_file(tmp_path):
    path = tmp_path / "in.csv"
    rows = [("a", "https://s.example.com/p/1", "wooden puzzle horse", "4000000000017"), ("a", "https://s.example.com/p/2", "wooden puzzle horse", ""),
            ("b", "https://s.example.com/p/3", "boat", ""), ("c", "https://s.example.com/p/4", "car", ""), ("d", " ", "none", "")]
    with open(path, "w", newline="", encoding="utf-8-sig") as out:
        writer = csv.writer(out)
        writer.writerow(["input_id", "url", "title", "gtin"])
        writer.writerows(rows)
    return str(path)


def test_a_batch_from_file_to_file(spark, tmp_path):
    apply_semantics(spark)
    pictures = spark.createDataFrame([(s, 0, f"images/{s}.jpg", "horse", "yes", "a horse", "direct", "") for s in ("a", "a__DUP02")], IMAGES)
    run = Batch(spark, batch_file(tmp_path), f"{tmp_path}/out", f"{tmp_path}/summary.json")
    rows = {r.input_id: r for r in run.run(captures(spark), pictures).collect()}
    assert tuple(next(iter(rows.values())).__fields__) == vocab.RESULT_COLUMNS
    assert sorted(rows) == ["a", "a__DUP02", "b", "c", "d"]
    a = rows["a"]
    assert (a.success, a.capture_profile_used, a.visual_evidence_status) == ("true", "load_wait", "final_product_images_available")
    assert (a.capture_profiles_attempted, a.table_count, a.final_image_count) == ("standard; load_wait", "1", "1")
    assert a.artifact_quality in ("strong", "usable") and int(a.quality_score) > 60 and "I" in a.evidence_axes_used
    assert rows["b"].artifact_quality == "insufficient" and rows["b"].requires_manual_review == "true"
    assert (rows["c"].artifact_quality, rows["c"].error) == ("not_created", "no capture for this request")
    assert "Missing required" in rows["d"].error and rows["d"].capture_decision_bucket == "not_created"
    summary = json.load(open(f"{tmp_path}/summary.json"))
    assert summary["total"] == 5 and summary["quality_counts"]["not_created"] == 2
    again = Batch(spark, run.input_csv, run.output_csv).run(captures(spark), pictures, resume=True)
    done = [r.input_id for r in again.collect()]
    assert done.count("a") == 1 and done.count("c") == 2


def test_command_line(spark, tmp_path):
    given = batch_file(tmp_path)
    assert main(["preflight", given, f"{tmp_path}/unique"], spark) == 0
    assert main(["preflight", given, f"{tmp_path}/none", "--fail-on-duplicates"], spark) == 2
    rows = [r for part in glob.glob(f"{tmp_path}/unique/*.csv") for r in csv.DictReader(open(part))]
    assert [r["input_id"] for r in rows][:2] == ["a", "a__DUP02"]
    captures(spark).write.parquet(f"{tmp_path}/captures")
    assert main(["batch", given, f"{tmp_path}/captures", f"{tmp_path}/out", "--summary", f"{tmp_path}/s.json"], spark) == 0
    whole = spark.read.options(header=True).csv(f"{tmp_path}/out").coalesce(1)
    whole.write.options(header=True).csv(f"{tmp_path}/whole")
    assert main(["triage", f"{tmp_path}/whole", f"{tmp_path}/triage", f"{tmp_path}/t.json"], spark) == 0
    assert json.load(open(f"{tmp_path}/t.json"))["total_rows"] == 5


def test_audit_command(spark, tmp_path):
    (tmp_path / "root/x/retailer").mkdir(parents=True)
    (tmp_path / "root/x/_FAILED.json").write_text('{"error": "boom"}')
    (tmp_path / "root/x/retailer/vision.md").write_text("seen")
    assert main(["audit", f"{tmp_path}/root", f"{tmp_path}/audit", f"{tmp_path}/audit.json"], spark) == 0
    assert json.load(open(f"{tmp_path}/audit.json"))["by_status"] == {"failed_finalized": 1}


def test_settings_from_the_environment():
    env = {"PCA_MAX_IMAGES": "7", "PCA_VISION_MAX": "x", "PCA_GEO_PROXY_ENABLED": "off", "PCA_PROXY_URL": "http://p", "PCA_PROXY_URL_CZ": "http://cz"}
    found = Settings.from_environment(env)
    assert (found.max_images, found.vision_max, found.geo_proxy_enabled) == (7, 12, False)
    assert (proxy_url("cz", env), proxy_url("de", env), accept_language("de", env)) == ("http://cz", "http://p", "")


def test_documents_are_written_whole(spark, tmp_path):
    sinks.write_json(spark, f"{tmp_path}/x.json", {"b": {3, 1}, "a": (tmp_path / "y", None)})
    sinks.write_json(spark, f"{tmp_path}/x.json", {"n": 1})
    assert json.load(open(f"{tmp_path}/x.json")) == {"n": 1} and not (tmp_path / "x.json.tmp").exists()


def test_nested_tables_leave_the_outer_one_whole():
    _, tables = H.extract_page("<table><tr><td>a <table><tr><td>in</td></tr></table> b</td><td>c</td></tr></table>", "https://x")
    assert [(t["n_rows"], t["n_columns"], t["markdown"].splitlines()[0]) for t in tables] == [(1, 2, "| a in b | c |")]


@pytest.mark.parametrize("hashes", [[0, 1, 0xFFFF, 0xFFFE, 1 << 62]])
def test_near_duplicates_fold_alt_texts(spark, hashes):
    rows = [("s", i, h, 10 + (i == 1), 1, f"alt{i}") for i, h in enumerate(hashes)]
    found = images.near_duplicates(spark.createDataFrame(rows, "scrape_id string, ordinal int, phash long, area long, bytes long, alt string")).collect()
    kept = {r.ordinal: r.alt for r in found if r.kept}
    assert kept == {1: "alt1 | alt0 | alt4", 2: "alt2 | alt3"}


def test_selection_of_images(spark):
    rows = [("s", i, f"https://x/{u}.jpg", f"alt{i}", sha, 1 << (8 * i), 10 - i, 10, 5, rel, "", "direct", "") for i, (u, sha, rel) in enumerate(
        [("a", "h1", "yes"), ("b", "h1", "yes"), ("a", "h1", "yes"), ("logo", "h2", "yes"), ("c", None, ""), ("d", "h3", "no")])]
    given = spark.createDataFrame(rows, "scrape_id string, ordinal int, url string, alt string, sha8 string, phash long, width int, height int, bytes long,"
                                  " relevance string, description string, download_source string, error string")  # fmt: skip
    found = {r.url[-5]: r for r in images.select_images(given, near=0).collect()}
    assert sorted(found) == ["a", "b", "c", "d"]
    assert found["a"].kept and found["a"].alt == "alt0 | alt1" and found["b"].duplicate and not found["b"].kept
    assert not found["c"].kept and found["d"].relevance_final == "no" and not found["d"].kept


def test_pixels_hash_and_payload_texts(spark):
    grey = [(i * 37 + j * 11) % 256 for i in range(32) for j in range(32)]
    row = spark.createDataFrame([(grey,), (None,)], "p array<int>").select(images.perceptual_hash("p").alias("h")).collect()
    assert row[0].h == f"{images.perceptual_bits(__import__('numpy').array(grey).reshape(32, 32)):016x}" and row[1].h is None
    text = spark.range(1).select(T.payload_text(F.parse_json(F.lit('{"fit_markdown": "", "markdown": {"html": ["x", "y"]}}'))).alias("t")).first().t
    assert text == "x\ny"


def test_empty_batches(spark):
    none = spark.createDataFrame([], "success string, requires_manual_review string, artifact_quality string")
    assert batch.batch_summary(none).first().total == 0
    rows = batch.union_columns(none.select("success"), spark.createDataFrame([("x",)], "other string")).collect()
    assert [tuple(r) for r in rows] == [("", "x")]


def test_files_by_path_and_strict_evidence(spark, tmp_path):
    from evigrade.sources.artifacts import strict_evidence, with_texts

    rows = spark.createDataFrame([(1, "a.md", "b.md"), (2, "", "gone.md"), (3, None, "a.md")], "k int, claims string, source string")
    files = spark.createDataFrame([("a.md", "A" * 9), ("b.md", "B")], "path string, text string")
    found = sorted((r.k, r.claims_text, r.source_text) for r in with_texts(rows, files, ["claims", "source"], 5).collect())
    assert found == [(1, "AAAAA", "B"), (2, "", ""), (3, "", "AAAAA")]
    (tmp_path / "good.json").write_text('{"items": [{"title": "t"}, {"text": "x"}]}')
    (tmp_path / "bad.json").write_text('"words"')
    assert [r.title for r in strict_evidence(spark, f"{tmp_path}/good.json").collect()] == ["t", None]
    with pytest.raises(ValueError, match="no list"):
        strict_evidence(spark, f"{tmp_path}/bad.json")


def test_other_sinks_and_counts(spark, tmp_path):
    from evigrade.engine import enrichment_counts

    rows = spark.createDataFrame([("1", "https://x/p", "brand price", "true")], "row_number string, product_url string, title string, success string")
    sinks.write_business_rows(rows, f"{tmp_path}/business")
    found = spark.read.options(header=True).csv(f"{tmp_path}/business").first()
    assert found.ean_match_status == "not_provided" and found.manual_review_bucket.startswith("REVIEW")
    sinks.append_result_rows(rows, f"{tmp_path}/out")
    sinks.append_result_rows(rows, f"{tmp_path}/out")
    assert spark.read.options(header=True).csv(f"{tmp_path}/out").count() == 2
    debug = spark.createDataFrame([("a", 0, "m", "h", True), ("b", 0, "m", "h", None)], "scrape_id string, ordinal int, raw_markdown string, raw_html string, write_raw_debug boolean")
    sinks.write_raw_debug(debug, f"{tmp_path}/raw")
    assert [r.scrape_id for r in spark.read.parquet(f"{tmp_path}/raw").collect()] == ["a"]
    before = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "k int, a string, b string")
    after = spark.createDataFrame([(1, "x", "new"), (2, "y", "z")], "k int, a string, b string")
    assert tuple(enrichment_counts(before, after, ["k"], ["a", "b"]).first()) == (2, 1, 1)
    assert tuple(enrichment_counts(after, after, ["k"], ["a", "b"]).first()) == (2, 0, 0)


def test_settings_of_a_batch_take_effect(spark, tmp_path):
    apply_semantics(spark)
    pictures = spark.createDataFrame([("a", i, f"images/{i}.jpg", "horse", "yes", "a horse", "direct", "") for i in range(5)], IMAGES)

    def graded(**given):
        run = Batch(spark, batch_file(tmp_path), f"{tmp_path}/out", settings=Settings(**given))
        good, _ = run.requests()
        return good, {r.scrape_id: r for r in grade(good, captures(spark), pictures, run.settings).collect()}

    _, rows = graded()
    assert (rows["a"].capture_profile_used, len(rows["a"].images)) == ("load_wait", 5)
    good, rows = graded(scrape_profile_max_profiles=1, max_images=2, vision_max=7)
    assert (rows["a"].capture_profile_used, len(rows["a"].images)) == ("standard", 2)
    assert {r.vision_max for r in good.collect()} == {7}
    scored = spark.createDataFrame([("a", 0, 60, True, 1, "x"), ("a", 1, 90, True, 1, "x")], "scrape_id string, ordinal int, capture_score int, real_scrape_evidence boolean, n_images int, raw_markdown string")
    assert [capture.best_capture(scored, True, stop).first().ordinal for stop in (82, 50)] == [1, 0]

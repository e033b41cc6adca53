"""Image manifests by request: one aggregate, one join."""

from evigrade.operators import images
from evigrade.plans import evidence_queries as E

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_triage_full_joins_manifests_once(spark):
    assert _plan(E.triage_full(spark, SMALL)).count("Join") == 1


def test_manifest_counts(spark):
    schema = "scrape_id string, ordinal int, local_path string, error string, attempts array<string>"
    items = [
        ("a", 1, "x/screenshot_fallback.png", "", ["direct:0", None, "direct:0"]),
        ("a", 2, "", "Read timeout", ["retry:1"]),
        ("a", 3, None, "Read timeout", None),
        ("b", 1, None, None, []),
    ]
    rows = spark.createDataFrame([("a", "", 0, 5, 0, False), ("b", "", 0, 5, 0, False), ("c", "", 0, 0, 0, False)],
        "scrape_id string, visual_evidence_status string, final_image_count int, image_candidate_count int, image_downloaded_count int, screenshot_fallback_used boolean")
    found = {r.scrape_id: r for r in images.image_diagnostics(rows, spark.createDataFrame(items, schema)).collect()}
    assert found["a"].image_attempt_buckets == "direct:0:2; retry:1:1"
    assert found["a"].image_error_buckets == "timeout:2" and found["a"].image_manifest_item_count == 3
    assert found["a"].screenshot_fallback_file_detected and not found["b"].screenshot_fallback_file_detected
    assert found["b"].image_error_buckets == "" and found["b"].image_manifest_item_count == 1
    assert found["c"].image_manifest_item_count == 0 and found["c"].image_failure_bucket == "no_image_candidates"

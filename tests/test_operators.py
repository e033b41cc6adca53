"""Operators of the evidence engine."""

from pyspark.sql import functions as F

from evigrade.operators import audit, batch, capture, classify, images, readiness, validate

CAPTURE = (
    "scrape_id string, ordinal int, title string, description string, raw_markdown string, raw_html string, access_status string,"
    " success boolean, n_json_ld int, n_tables int, n_og int, n_meta int, n_images int"
)


def scored(spark, *rows):
    return capture.score_captures(spark.createDataFrame([("a", i, *r) for i, r in enumerate(rows)], CAPTURE)).orderBy("ordinal").collect()


def test_capture_scores(spark):
    shell, empty, mixed = scored(
        spark,
        ("Robot Check", "", "captcha robot check", "<html>", "accessible", True, 0, 0, 0, 0, 0),
        ("", "", "", "", "accessible", True, 0, 0, 0, 0, 1),
        ("Red robot", "", "product brand price details " * 500 + "captcha", "x" * 9000, "accessible", True, 0, 1, 0, 0, 20),
    )
    assert shell.capture_decision == "blocked_shell_capture" and not shell.real_scrape_evidence
    assert "block_or_challenge_terms" in shell.weak_reasons
    assert (empty.capture_score, empty.capture_decision) == (0, "input_url_only_artifact")
    assert "no_readable_content" in empty.weak_reasons
    assert mixed.capture_decision == "mixed_capture_needs_review" and mixed.real_scrape_evidence


def test_alignment(spark):
    rows = spark.createDataFrame(
        [("Shop", "DE", "shop!", "de", ""), ("Shop", "DE", "Other", "DE", ""), ("", "", "", "", ""), ("Shop", "DE", "Shop", "DE", "Global-Fallback")],
        "requested_retailer_name string, requested_country_code string, source_retailer_name string, source_country_code string, source_url_role string",
    )
    found = [r.alignment_status for r in classify.align_sources(rows).collect()]
    assert found == ["primary_requested_source", "source_context_mismatch", "not_declared", "fallback_source_used"]


def test_search_page_is_no_product_page(spark):
    rows = spark.createDataFrame([("https://x.de/search?q=toy", "true")], "product_url string, real_scrape_evidence string")
    row = classify.classify_pages(rows).first()
    assert row.page_classification_status == "category_or_search_or_non_product_page"
    assert not row.is_product_detail_page


def test_duplicate_ids(spark):
    rows = spark.createDataFrame([(1, "SKU1"), (2, "SKU1"), (3, "SKU2"), (4, ""), (5, None)], "row_number int, raw string")
    done = batch.unique_ids(rows, F.col("raw"), ["row_number"]).orderBy("row_number").collect()
    assert [r.input_id for r in done] == ["SKU1", "SKU1__DUP02", "SKU2", "row_000004", "row_000005"]


def test_requests_take_aliases_in_any_case(spark):
    rows = spark.createDataFrame([(1, "https://x", "Robot", "EAN 400", "Shop", "de"), (2, " ", "", "", "", "")],
                                 "row_number int, PRODUCT_URL string, MAIN_TEXT string, GTIN string, RETAILER string, COUNTRY string")
    good, bad = batch.requests_from_rows(rows)
    row = good.first()
    assert (row.main_text, row.ean, row.requested_retailer_name, row.requested_country_code) == ("Robot", "400", "Shop", "DE")
    assert bad.count() == 1


def test_usable_capture_without_image_needs_an_image(spark):
    rows = spark.createDataFrame(
        [("https://x/p/1", "Red wooden robot", "red wooden robot set", "true", "usable_product_capture", "true", "image_recovery_failed", "0", "usable")],
        "product_url string, title string, main_text string, success string, capture_decision string, real_scrape_evidence string,"
        " visual_evidence_status string, final_image_count string, artifact_quality string",
    )
    row = validate.validate_rows(rows).first()
    assert row.manual_review_bucket == "REVIEW_IMAGE_FAILED" and not row.visual_success
    # 30 for the image, 10 for a weak match: only three words to match
    assert row.business_validation_score == 60


def test_image_errors_and_diagnostics(spark):
    rows = spark.createDataFrame([("a", "", 0, 3, 0, False)], "scrape_id string, visual_evidence_status string, final_image_count int, image_candidate_count int, image_downloaded_count int, screenshot_fallback_used boolean")
    items = spark.createDataFrame([("a", 1, "", "http 403", ["referer:403"]), ("a", 2, "", "timeout", []), ("a", 3, "", "403", ["referer:403"])],
                                  "scrape_id string, ordinal int, local_path string, error string, attempts array<string>")
    row = images.image_diagnostics(rows, items).first()
    assert row.image_failure_bucket == "image_fetch_forbidden"
    assert row.image_error_buckets == "image_fetch_forbidden:2; timeout:1"
    assert row.image_attempt_buckets == "referer:403:2"


def test_greedy_near_duplicates_follow_scan_order(spark):
    rows = spark.createDataFrame([("a", 1, 0, 10, 1), ("a", 2, 0b111, 20, 1), ("a", 3, 0b111111111, 5, 1), ("a", 4, None, 1, 1)],
                                 "scrape_id string, ordinal int, phash long, area long, bytes long")
    found = {r.ordinal: (r.kept, r.cluster) for r in images.near_duplicates(rows).collect()}
    assert found == {1: (False, 0), 2: (True, 0), 3: (False, 0), 4: (True, 1)}


def test_claims_enrich_once(spark):
    claims = spark.createDataFrame([("a", "retailer_claims", "recommended age", "3+")], "scrape_id string, claim_source string, attribute string, value string")
    done = readiness.enrich_claims(claims)
    assert done.first().coding_relevance == "age_range"
    assert readiness.enrich_claims(done).first().asDict() == {**done.first().asDict(), "conflict_status": "not_evaluated"}


def test_audit_statuses(spark):
    full = [(f, 5, "{}") for f in audit.required_files()] + [("_COMPLETE.json", 5, "{}"), ("retailer/images/1.JPG", 5, None)]
    result = '{"visual_evidence_status":"final_product_images_available","artifact_quality":"strong","requires_manual_review":false}'
    full = [(f, s, result if f == "scrape_result.json" else t) for f, s, t in full]
    rows = [("ready", *f) for f in full] + [("open", "request.json", 5, "{}")]
    files = spark.createDataFrame(rows, "scrape_id string, rel_path string, size int, text string")
    found = {r.scrape_id: r.artifact_status for r in audit.audit_artifacts(files).collect()}
    assert found == {"ready": "ready_for_coding", "open": "incomplete_no_terminal_marker"}


def test_resume_leaves_out_what_succeeded(spark):
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "input_id string")
    done = spark.createDataFrame([("a", "True"), ("b", "no"), ("a", "false")], "input_id string, success string")
    assert sorted(r[0] for r in batch.still_to_do(asked, done).collect()) == ["b", "c"]


def test_terms_are_found_in_distinct_pieces(spark):
    """The pieces are short however long a page is, and give the counts of the whole text."""
    from evigrade.functions import text as T
    from evigrade.functions import vocab

    pages = ["", "robot check", "robot x check", "Not a Robot / a b", "packaGE\nitem  model", "item model number/toy", "a<set>b/ean", "<div>x</div>" * 3000 + "doll captcha"]
    rows = spark.createDataFrame([(p,) for p in pages], "page string").withColumn("whole", F.lower("page"))
    pieces = F.lower(T.distinct_pieces("page"))
    terms = vocab.CAPTURE_PRODUCT_TERMS + vocab.CAPTURE_BLOCK_TERMS
    own = T.count_terms(F.col("whole"), terms, F.col("pieces")).alias("own")
    hinted = T.hint_score(F.col("whole"), F.lit("Toy set / robot"), F.lit("a b"), F.col("pieces")).alias("hinted")
    both = rows.withColumn("pieces", pieces).select(own, hinted, T.count_terms(F.col("whole"), terms).alias("all"),
                                                    T.hint_score(F.col("whole"), F.lit("Toy set / robot"), F.lit("a b")).alias("hint"), F.length("pieces").alias("n"))
    found = both.collect()
    assert [(r.own, r.hinted) for r in found] == [(r["all"], r.hint) for r in found]
    assert found[1]["all"] == 1 and found[2]["all"] == 0 and found[-1]["all"] == 2 and found[-1].n < 100

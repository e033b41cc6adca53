"""The artifact quality gate and the recovery report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import any_term, filled, listed
from evigrade.operators.evidence import signal


def quality_gate(rows: DataFrame) -> DataFrame:
    """Add quality_score, artifact_quality, requires_manual_review, missing_critical_fields, quality_warnings,
    n_warnings, checks (a struct of fifteen) and recommended_followups.

    rows: evidence_text (the evidence as JSON text, key names count too), page_title,
    main_text, ean, url, raw_markdown, product_text_chars, n_retailer_claims,
    n_claims, n_structured (tables, JSON-LD, meta and their claims), n_tables,
    n_json_ld, n_images, n_downloaded, n_clean, n_screenshots, n_described,
    n_errors, n_forbidden, n_axes, image_required, real_scrape_evidence,
    weak_capture, access_status, capture_grade, capture_decision, alignment_status;
    optionally browser_visible, has_upstream and requested_retailer_claims_allowed; page_signals may stand for raw_markdown.
    """
    have = set(rows.columns)
    page = signal("markdown_trimmed", False) if "page_signals" in have else F.trim(filled("raw_markdown")) != ""
    blob = F.lower(filled("evidence_text"))
    decision, grade = filled("capture_decision"), filled("capture_grade")
    real = F.coalesce("real_scrape_evidence", F.lit(False))
    required = F.coalesce("image_required", F.lit(True))
    name = any_term(blob, ("product_name", "product name", "name", "title")) | (filled("page_title") != "") | (filled("main_text") != "")
    brand = any_term(blob, ("brand", "manufacturer", "publisher"))
    identifier = (filled("ean") != "") | any_term(
        blob, ("ean", "gtin", "barcode", "isbn", "sku", "mpn", "article", "artikeldetails")
    )
    url = filled("url") != ""
    text = (F.col("product_text_chars") >= 80) | (F.col("n_retailer_claims") > 0) | page
    visual, shot = F.col("n_clean") > 0, F.col("n_screenshots") > 0
    structured, axes = F.col("n_structured") > 0, F.col("n_axes") > 0
    told = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in have else F.lit(False)
    open_page = F.col("access_status") == "accessible"
    aligned = F.col("alignment_status") == "primary_requested_source"
    scope = F.when(aligned, "requested_retailer_and_country").otherwise("scraped_source_only")
    checks = {
        "has_product_name_or_title": name,
        "has_brand_signal": brand,
        "has_identifier_signal": identifier,
        "has_retailer_url": url,
        "has_product_text": text,
        "has_visual_evidence": visual,
        "has_any_visual_file": F.col("n_downloaded") > 0,
        "has_screenshot_fallback": shot,
        "has_table_or_structured_evidence": structured,
        "has_evidence_axes": axes,
        "has_gap_reporting": F.lit(True),
        "noise_exclusion_documented": F.lit(True),
        "browser_access_ok_or_recovered": told("browser_visible") | real | told("has_upstream"),
        "source_alignment_documented": F.lit(True),
        "fallback_claim_scope_safe": F.lit(True),
    }
    missing = listed(
        (~name, "product_name_or_title"),
        (~brand, "brand_or_manufacturer_signal"),
        (~url, "retailer_url"),
        (required & ~visual, "visual_product_image"),
        (~text & ~structured & ~visual, "product_evidence_content"),
        (~axes, "evidence_axis_tags"),
    )
    quarter = F.greatest(F.lit(3), F.floor(F.col("n_images") / 4))
    open_warnings = (
        (F.col("n_forbidden") > 0, "n_forbidden"),
        ((F.col("n_errors") > 0) & (F.col("n_downloaded") < quarter), None),
        (~visual, None),
        (shot, None),
        (F.col("n_described") == 0, None),
        ((F.col("n_tables") == 0) & (F.col("n_json_ld") == 0), None),
        (~open_page, "access_status"),
        (F.col("weak_capture") & open_page, None),
        (~real, None),
        (grade.isin(*vocab.WEAK_GRADES), "capture_grade"),
        (decision.isin(*vocab.GATE_DOUBTFUL_DECISIONS), "capture_decision"),
        (~aligned, "alignment_status"),
    )
    said = [F.format_string(t, F.col(c).cast("string"), scope) if c else t for (_, c), t in zip(open_warnings, vocab.GATE_WARNINGS)]
    warnings = listed(*[(condition, t) for (condition, _), t in zip(open_warnings, said)])
    gap = lambda name: F.array_contains("missing_critical_fields", name)
    advice = (
        gap("product_name_or_title") | gap("product_evidence_content"),
        ~visual,
        shot,
        F.col("n_described") == 0,
        F.col("n_forbidden") > 0,
        ~open_page,
        (filled("main_text") == "") & (filled("ean") == ""),
    )
    followups = listed(*zip(advice, vocab.GATE_FOLLOWUPS))
    df = rows.withColumns({"quality_warnings": warnings, "missing_critical_fields": missing})
    df = df.withColumns(
        {
            "n_warnings": F.size("quality_warnings"),
            "checks": F.struct(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()]),
            "recommended_followups": followups,
        }
    )
    gain = lambda condition, points: F.when(condition, points).otherwise(0)
    score = (
        gain(name, 20)
        + gain(brand, 15)
        + gain(identifier, 10)
        + gain(url, 10)
        + gain(text, 15)
        + gain(structured, 10)
        + gain(visual, 15)
        + gain(shot, 4)
        + gain(axes, 10)
        + F.lit(5)
        + gain(F.col("n_claims") >= 5, 5)
        - gain(F.col("n_warnings") >= 3, 10)
        - gain(~real, 25)
        - F.when(decision.isin("blocked_shell_capture", "empty_or_blocked_capture"), 25)
        .when(decision == "mixed_capture_needs_review", 8)
        .otherwise(0)
        - F.when(grade == "blocked_or_shell", 20).when(grade == "mixed_capture", 15).when(grade == "weak", 10).otherwise(0)
        - gain(decision.isin("input_url_only_artifact", "fetch_failed_input_url_only_artifact", "blocked_or_challenge_capture"), 15)
        - gain(required & ~visual, F.when(shot, 20).otherwise(30))
    )
    df = df.withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int"))
    s, gaps = F.col("quality_score"), F.size("missing_critical_fields") > 0
    quality = (
        F.when(required & ~visual & ~shot, "insufficient")
        .when(required & ~visual, "partial")
        .when(gaps, F.when(s >= 45, "partial").otherwise("insufficient"))
        .when(~real, F.when(s >= 55, "partial").otherwise("insufficient"))
        .when(decision == "mixed_capture_needs_review", F.when(s >= 75, "usable").otherwise("partial"))
        .when((s >= 85) & (F.col("n_warnings") <= 1), "strong")
        .when(s >= 65, "usable")
        .otherwise("partial")
    )
    df = df.withColumn("artifact_quality", quality)
    review = F.col("artifact_quality").isin("partial", "insufficient") | gaps | decision.isin(*vocab.GATE_REVIEW_DECISIONS)
    return df.withColumn("requires_manual_review", review)


def recovery_status(rows: DataFrame) -> DataFrame:
    """Add recovery_status.  rows: browser_visible, proxy_used, has_upstream, has_metadata, recovered."""
    ok = F.col("recovered")
    status = (
        F.when(F.col("browser_visible") & ok, "browser_primary")
        .when(F.col("proxy_used") & ok, "proxy_primary")
        .when(F.col("has_upstream") & ok, "upstream_recovery")
        .when(F.col("has_metadata") & ok, "metadata_recovery")
        .when(ok, "recovered")
        .otherwise("insufficient_evidence")
    )
    return rows.withColumn("recovery_status", status)

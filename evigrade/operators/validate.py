"""Business validation, triage and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import (
    any_term, bound, business_tokens, count_terms, digits_only, filled, int_or, is_true, listed,
)
from evigrade.operators.classify import classify_pages, normal_role

_READY_IDENTITIES = ("matched_by_ean", "matched_by_title_tokens", "weak_match_by_title_tokens", "no_input_identity")
_BROKEN_SOURCES = ("fallback_source_used", "source_context_mismatch")


def ean_status(ean: Column | str, blob: Column) -> Column:
    """struct(status, candidates): the EAN among all digits of the text, else other identifiers that stand alone."""
    none = F.array().cast("array<string>")
    state = lambda status, candidates: F.struct(status.alias("status"), candidates.alias("candidates"))

    def sought(wanted: Column) -> Column:
        runs = F.filter(F.split(blob, "[^0-9]+"), lambda r: F.length(r).isin(8, 12, 13, 14))
        others = F.filter(F.array_sort(F.array_distinct(runs)), lambda r: r != wanted)
        named = lambda o: F.when(F.size(o) > 0, "possible_identifier_conflict").otherwise("not_found_in_source")
        return (
            F.when(wanted == "", state(F.lit("not_provided"), none))
            .when(F.contains(digits_only(blob), wanted), state(F.lit("matched"), F.array(wanted)))
            .otherwise(bound(others, lambda o: state(named(o), F.slice(o, 1, 8))))
        )

    return bound(digits_only(ean), sought)


def identity_words(main_text: Column | str) -> Column:
    """The words of what was asked for that are looked up."""
    return F.slice(business_tokens(main_text), 1, 32)


def identity_status(main_text: Column | str, ean_state: Column, blob: Column) -> Column:
    """struct(status, score, terms): how much of what was asked for stands in the text."""
    return identity_of(identity_words(main_text), ean_state, blob)


def identity_of(words: Column, ean_state: Column, blob: Column) -> Column:
    """identity_status() of identity_words()."""

    def judged(words: Column, hits: Column) -> Column:
        n = F.size(hits)
        ratio = F.coalesce(F.try_divide(n, F.size(words)), F.lit(0.0))
        status = (
            F.when(ean_state == "matched", "matched_by_ean")
            .when(F.size(words) == 0, "no_input_identity")
            .when((n >= 4) & (ratio >= 0.65), "matched_by_title_tokens")
            .when((n >= 3) & (ratio >= 0.45), "weak_match_by_title_tokens")
            .when(n > 0, "partial_token_overlap")
            .otherwise("input_not_found_in_capture")
        )
        score = F.when(ean_state == "matched", F.lit(1.0)).otherwise(F.bround(ratio, 3))
        terms = F.when(ean_state == "matched", F.array().cast("array<string>")).otherwise(hits)
        return F.struct(status.alias("status"), score.alias("score"), terms.alias("terms"))

    return bound(words, lambda all: bound(F.filter(all, lambda w: F.contains(blob, w)), lambda hits: judged(all, hits)))


def declared_alignment(rows: DataFrame) -> Column:
    """The row's own alignment status, or one from its role."""
    have = set(rows.columns)
    get = lambda name: filled(name) if name in have else F.lit("")
    role = normal_role(get("source_url_role"))
    from_role = (
        F.when(role.isin(*vocab.PRIMARY_ROLES), "primary_requested_source")
        .when(role.isin(*vocab.BUSINESS_FALLBACK_ROLES), "fallback_source_used")
        .otherwise("not_declared")
    )
    return F.coalesce(F.nullif(F.trim(get("source_alignment_status")), F.lit("")), from_role)


def validate_rows(rows: DataFrame, texts: tuple[str, ...] = ()) -> DataFrame:
    """Add the nineteen business columns to result rows.

    texts: columns that hold the artifact's texts; at most 120,000 characters of each count.
    A fallback source sets error while success stays true, so such rows fail technically.
    """
    have = set(rows.columns)
    get = lambda name: filled(name) if name in have else F.lit("")
    parts = ["product_url", "final_url", "title", "weak_capture_reasons", "missing_critical_fields", "quality_warnings"]
    pieces = [F.nullif(get(p), F.lit("")) for p in parts] + [F.nullif(F.left(filled(t), F.lit(120_000)), F.lit("")) for t in texts]
    df = rows.withColumn("_blob", F.lower(F.concat_ws("\n", *pieces)))
    blob = F.col("_blob")
    df = df.withColumn("_ean", ean_status(get("ean"), blob))
    df = df.withColumn("_identity", identity_status(get("main_text"), F.col("_ean.status"), blob))
    df = df.withColumn("_terms", count_terms(blob, vocab.BUSINESS_PRODUCT_TERMS))
    real = is_true(get("real_scrape_evidence"))
    address = F.concat_ws("\n", get("product_url"), get("final_url"), get("title"))
    matches = address.rlike(f"(?i){vocab.BUSINESS_CATEGORY_PATH}") | address.rlike(f"(?i){vocab.BUSINESS_CATEGORY_QUERY}")
    many = F.col("_terms") >= 4
    category = (matches & ~(real & many)) | (~real & any_term(F.left(blob, F.lit(30_000)), vocab.BUSINESS_LISTING_TERMS))
    decision = F.coalesce(F.nullif(get("capture_decision"), F.lit("")), F.lit("not_evaluated"))
    rich = decision.isin("rich_product_capture", "usable_product_capture")
    visual = get("visual_evidence_status")
    missing = F.size(F.filter(F.split(get("missing_critical_fields"), ";"), lambda m: F.trim(m) != "")) > 0
    df = df.withColumns(
        {
            "is_category_or_search_page": category,
            "is_marketplace_page": any_term(F.left(blob, F.lit(80_000)), vocab.BUSINESS_MARKETPLACE_TERMS),
            "technical_success": is_true(get("success")) & (F.trim(get("error")) == ""),
            "scrape_success": real & (rich | (decision == "mixed_capture_needs_review")),
            "visual_success": (visual == "final_product_images_available") & (int_or(get("final_image_count"), 0) >= 1),
            "_source": declared_alignment(rows),
        }
    )
    category = F.col("is_category_or_search_page")
    df = df.withColumn("is_product_detail_page", ~category & real & (rich | many))
    identity, ean = F.col("_identity.status"), F.col("_ean.status")
    quality = get("artifact_quality").isin("strong", "usable")
    evidence = quality & ~missing & F.col("is_product_detail_page") & identity.isin(*_READY_IDENTITIES)
    df = df.withColumn("evidence_success", evidence)
    refused = get("access_status").isin(*vocab.BLOCKED_ACCESS)
    broken = F.col("_source").isin(*_BROKEN_SOURCES)
    conflict = (ean == "possible_identifier_conflict") | (identity == "input_not_found_in_capture")
    weak = get("capture_grade").isin(*vocab.WEAK_GRADES) | decision.isin(*vocab.REVIEW_DECISIONS)
    ladder = (
        (~F.col("technical_success"), "FAILED_TECHNICAL"),
        (refused | decision.isin("blocked_shell_capture", "blocked_or_challenge_capture"), "REVIEW_BLOCKED_ACCESS"),
        (conflict, "REVIEW_IDENTITY_CONFLICT"),
        (category | ~F.col("is_product_detail_page"), "REVIEW_NOT_PRODUCT_DETAIL_PAGE"),
        (~F.col("visual_success") & (visual == "screenshot_fallback_only"), "REVIEW_IMAGE_ONLY"),
        (~F.col("visual_success"), "REVIEW_IMAGE_FAILED"),
        (broken, "REVIEW_SOURCE_FALLBACK"),
        (weak, "REVIEW_WEAK_CAPTURE"),
        (missing | ~F.col("evidence_success"), "REVIEW_MISSING_CRITICAL_FIELDS"),
        (is_true(get("requires_manual_review")), "REVIEW_REQUIRED_BY_QUALITY_GATE"),
    )
    bucket = F.lit("READY_FOR_CODING")
    for condition, name in reversed(ladder):
        bucket = F.when(condition, name).otherwise(bucket)
    cost = lambda condition, points: F.when(condition, points).otherwise(0)
    score = (
        F.lit(100)
        - cost(~F.col("technical_success"), 60)
        - cost(~F.col("scrape_success"), 25)
        - cost(~F.col("evidence_success"), 20)
        - cost(~F.col("visual_success"), 30)
        - F.when(identity == "input_not_found_in_capture", 35)
        .when(identity.isin("partial_token_overlap", "weak_match_by_title_tokens"), 10)
        .otherwise(0)
        - cost(ean == "possible_identifier_conflict", 40)
        - cost(category, 35)
        - cost(broken, 10)
    )
    conflicts = listed(
        (ean == "possible_identifier_conflict", "ean_or_identifier_conflict"),
        (identity == "input_not_found_in_capture", "input_identity_not_found_in_capture"),
        (category, "category_or_search_page_not_product_detail_page"),
        (~F.col("visual_success"), "clean_product_image_missing"),
        (refused, F.concat(F.lit("access_status_"), get("access_status"))),
        (broken, F.col("_source")),
    )
    variant = (
        F.when(identity.isin("matched_by_ean", "matched_by_title_tokens"), "aligned_or_not_detected")
        .when(identity.isin("weak_match_by_title_tokens", "partial_token_overlap"), "possible_variant_risk")
        .when(identity == "input_not_found_in_capture", "possible_variant_or_wrong_product")
        .otherwise("not_evaluated")
    )
    df = df.withColumns({"manual_review_bucket": bucket, "_conflicts": conflicts})
    isolation = (
        F.when(visual == "screenshot_fallback_only", "screenshot_needs_main_product_review")
        .when(F.col("is_marketplace_page"), "marketplace_page_needs_seller_scope_review")
        .when(F.col("is_product_detail_page"), "isolated_main_product")
        .otherwise("not_isolated_or_not_product_page")
    )
    why = F.when(F.size("_conflicts") > 0, F.array_join("_conflicts", "; ")).otherwise(F.col("manual_review_bucket"))
    return df.withColumns(
        {
            "business_validation_status": F.when(F.col("manual_review_bucket") == "READY_FOR_CODING", "ready")
            .when(F.col("manual_review_bucket") == "FAILED_TECHNICAL", "failed")
            .otherwise("review"),
            "business_validation_score": F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int"),
            "manual_review_reason": why,
            "identity_match_status": identity,
            "identity_match_score": F.col("_identity.score"),
            "identity_match_terms": F.array_join("_identity.terms", "; "),
            "ean_match_status": ean,
            "ean_conflict_candidates": F.array_join("_ean.candidates", "; "),
            "variant_match_status": variant,
            "main_product_isolation_status": isolation,
            "critical_conflicts": F.array_join("_conflicts", "; "),
        }
    ).drop("_blob", "_ean", "_identity", "_terms", "_source", "_conflicts")


def triage_priority(bucket: Column | str) -> Column:
    """How urgent a review bucket is; 30 for an unknown one."""
    pairs = [F.lit(x) for pair in vocab.TRIAGE_PRIORITY.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), filled(bucket)), F.lit(vocab.DEFAULT_PRIORITY))


def triage_rows(rows: DataFrame, texts: tuple[str, ...] = ()) -> DataFrame:
    """Business columns, then page classes, which replace three flags after the bucket is known, and the priority."""
    validated = validate_rows(rows, texts)
    return classify_pages(validated).withColumn("triage_priority", triage_priority("manual_review_bucket"))


def triage_order(rows: DataFrame) -> DataFrame:
    """Most urgent first, stable in input order."""
    return rows.orderBy(F.desc("triage_priority"), F.asc("row_number"))


def triage_summary(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(dimension, value, n): one histogram for each column, in one pass over the rows; equal rows are counted first."""
    values = rows.groupBy(*[filled(c).alias(f"_{i}") for i, c in enumerate(columns)]).agg(F.count("*").alias("rows"))
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(f"_{i}").alias("value")) for i, c in enumerate(columns)])
    seen = values.select(F.explode(pairs).alias("p"), "rows").select("p.*", "rows")
    return seen.groupBy("dimension", "value").agg(F.sum("rows").alias("n"))

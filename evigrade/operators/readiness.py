"""Claims, features, identity and coding readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import any_term, col, digits_only, filled, markdown_cell, match_score

_VALUE_KEYS = ("value", "normalized_value", "claim", "content", "description", "text")
_ATTRIBUTE_KEYS = ("attribute", "field", "heading", "type", "claim_type", "claim_id")


def _first_of(columns: list[str], keys: tuple[str, ...], default: str) -> Column:
    given = [F.nullif(F.col(k), F.lit("")) for k in keys if k in columns]
    return F.coalesce(*given, F.lit(default))


def claim_value(claims: DataFrame) -> Column:
    return _first_of(claims.columns, _VALUE_KEYS, "")


def claim_attribute(claims: DataFrame) -> Column:
    return _first_of(claims.columns, _ATTRIBUTE_KEYS, "claim")


def infer_feature(attribute: Column, value: Column) -> Column:
    """The first feature one of whose aliases occurs in attribute and value."""
    blob = F.lower(F.concat_ws(" ", attribute, value))
    feature = F.lit(vocab.GENERAL_FEATURE)
    for name, aliases in reversed(vocab.FEATURE_ALIASES):
        feature = F.when(any_term(blob, aliases), name).otherwise(feature)
    return feature


def enrich_claims(claims: DataFrame) -> DataFrame:
    """Add the derived columns of claim rows, and where a claim may be used.

    claims: scrape_id, claim_source and any of the known keys.  Values that are
    there stay; running it again changes nothing.
    """
    value, attribute = claim_value(claims), claim_attribute(claims)
    own = F.col("claim_source") == "source_specific_claims"
    made = {
        "normalized_value": value,
        "coding_relevance": infer_feature(attribute, value),
        "evidence_summary": markdown_cell(value, 420),
        "downstream_action": F.when(own, "source_specific_only").otherwise("use_if_identity_and_quality_pass"),
        "transferability": F.when(own, "scraped_source_only").otherwise("product_level_transferable_when_identity_passes"),
        "confidence": F.when(value != "", "medium").otherwise("missing"),
        "missing_reason": F.when(value != "", "").otherwise("value missing or not directly extracted"),
    }
    if "confidence" in claims.columns:
        told = filled("confidence") != ""
        made["conflict_status"] = F.when(told, "no_conflict_reported").otherwise("not_evaluated")
    else:
        made["conflict_status"] = F.lit("not_evaluated")
    return claims.withColumns({k: F.coalesce(k, v) if k in claims.columns else v for k, v in made.items()})


def feature_readiness(claims: DataFrame, requests: DataFrame) -> DataFrame:
    """For every request and feature whether its claims support it: missing, medium or strong.

    claims: scrape_id, attribute, value, confidence, evidence_axis (array), and
    optionally raw_text and source_refs.  The alias table is fixed, so a claim's
    features are an array expression, not a join.
    """
    refs = F.array_join("source_refs", " ") if "source_refs" in claims.columns else F.lit("")
    raw = filled("raw_text") if "raw_text" in claims.columns else F.lit("")
    blob = F.lower(F.concat_ws(" ", claim_attribute(claims), claim_value(claims), raw, refs))
    marks = [F.when(any_term(blob, aliases), F.lit(name)) for name, aliases in vocab.FEATURE_ALIASES]
    met = claims.withColumn("feature", F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())))
    found = met.groupBy("scrape_id", "feature").agg(
        F.count("*").alias("matches"),
        F.coalesce(F.bool_or(F.lower(filled("confidence")) == "high"), F.lit(False)).alias("_high"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence_axis")))).alias("evidence_axes"),
    )
    names = F.explode(F.array(*[F.lit(name) for name, _ in vocab.FEATURE_ALIASES])).alias("feature")
    every = requests.select("scrape_id").distinct().select("scrape_id", names)
    df = every.join(found, ["scrape_id", "feature"], "left")
    strong = F.col("_high") | (F.col("matches") >= 2) | (F.size("evidence_axes") >= 2)
    status = F.when(F.col("matches").isNull(), "missing").when(strong, "strong").otherwise("medium")
    axes = F.coalesce("evidence_axes", F.array().cast("array<string>"))
    matches = F.coalesce("matches", F.lit(0)).alias("matches")
    return df.select("scrape_id", "feature", status.alias("status"), matches, axes.alias("evidence_axes"))


def verify_identity(rows: DataFrame) -> DataFrame:
    """Add main_text_match_score, ean_match_status and identity_status.

    rows: main_text, ean (asked for), product_title, ean_detected (found).
    """
    score = match_score("main_text", "product_title")
    asked, found = filled("ean") != "", filled("ean_detected") != ""
    same = asked & found & (digits_only("ean") == digits_only("ean_detected"))
    text = filled("main_text") != ""
    s = F.col("main_text_match_score")
    by_text = (
        F.when(text & (s >= 0.65), "strong")
        .when(text & (s >= 0.40), "medium")
        .when(text & (filled("product_title") != ""), "weak")
        .otherwise("unknown")
    )
    status = (
        F.when(same, "strong")
        .when(asked & found, F.when(s < 0.35, "wrong_item").otherwise("weak"))
        .otherwise(by_text)
    )
    told = F.when(same, "matched").when(~asked, "not_provided").otherwise("not_matched_or_missing")
    return rows.withColumn("main_text_match_score", score).withColumns({"ean_match_status": told, "identity_status": status})


def coding_readiness(rows: DataFrame) -> DataFrame:
    """Add ready_for_coding and recommended_downstream_action.

    rows: identity_status, artifact_quality, visual_evidence_status, requires_manual_review.
    """
    quality = F.coalesce(F.nullif(filled("artifact_quality"), F.lit("")), F.lit("not_evaluated"))
    ready = (
        F.col("identity_status").isin("strong", "medium")
        & quality.isin("strong", "usable")
        & filled("visual_evidence_status").isin("", "final_product_images_available")
        & ~F.coalesce("requires_manual_review", F.lit(False))
    )
    action = (
        F.when(F.col("identity_status") == "wrong_item", "do_not_code_rescrape")
        .when(ready, "safe_for_automated_product_coding")
        .when(quality.isin("partial", "usable"), "code_supported_features_only_and_review_gaps")
        .otherwise("manual_review_or_rescrape_recommended")
    )
    return rows.withColumns({"ready_for_coding": F.coalesce(ready, F.lit(False)), "recommended_downstream_action": action})


def evidence_axes(arrays: list[Column | str]) -> Column:
    """The distinct axes of all claims, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(*map(col, arrays)), lambda a: filled(a) != "")))

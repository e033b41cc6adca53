"""Page classes and source alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.functions import urls, vocab
from evigrade.functions.text import any_term, count_terms, filled, listed, normal_name, terms_in

_BLOB = (
    "product_url", "final_url", "title", "access_status", "access_issue_reason",
    "weak_capture_reasons", "quality_warnings", "missing_critical_fields",
)


def classify_pages(rows: DataFrame, extra_text: Column | str = "") -> DataFrame:
    """Add page_classification_status, _confidence, _reasons and four flags to result rows.

    rows need final_url or product_url; other columns count as empty where missing.
    """
    have = set(rows.columns)
    get = lambda name: filled(name) if name in have else F.lit("")
    extra = extra_text if isinstance(extra_text, Column) else F.lit(extra_text)
    url = F.coalesce(F.nullif(get("final_url"), F.lit("")), get("product_url"))
    blob = F.concat(F.lower(F.concat_ws("\n", *map(get, _BLOB))), F.lit("\n"), F.lower(filled(extra)))
    title = F.lower(F.trim(get("title")))
    df = rows.withColumn("_blob", F.left(blob, F.lit(120_000)))
    df = df.withColumn("_signals", count_terms(F.col("_blob"), vocab.PAGE_PRODUCT_SIGNALS))
    df = df.withColumn("_hits", terms_in(F.left("_blob", F.lit(40_000)), vocab.PAGE_BLOCK_SIGNALS))
    refused = get("access_status").isin(*vocab.REFUSED_ACCESS)
    df = df.withColumns(
        {
            "_block": (F.size("_hits") > 0) | refused,
            "_listing": urls.is_category(url),
            "_other": urls.is_non_product(url),
            "_real": F.lower(get("real_scrape_evidence")).isin("1", "true", "yes"),
        }
    )
    signals, real = F.col("_signals"), F.col("_real")
    category = F.col("_listing") | F.col("_other")
    specific = (title != "") & ~title.isin(*vocab.PAGE_UNSPECIFIC_TITLES)
    rich = get("capture_decision").isin("rich_product_capture", "usable_product_capture")
    detail = ~F.col("_block") & ~category & real & (rich | (signals >= 5) | (specific & (signals >= 3)))
    market = any_term(F.left("_blob", F.lit(80_000)), vocab.PAGE_MARKETPLACE_SIGNALS)
    named = F.when(F.size("_hits") > 0, F.array_join(F.slice("_hits", 1, 4), ",")).otherwise(
        F.coalesce(F.nullif(get("access_status"), F.lit("")), F.lit("unknown"))
    )
    reasons = listed(
        (F.col("_block"), F.concat(F.lit("block_or_challenge_signal:"), named)),
        (F.col("_listing"), "url_looks_like_search_or_category"),
        (F.col("_other"), "url_looks_like_non_product_page"),
        (signals >= 5, F.concat(F.lit("product_signals="), signals)),
        (signals.between(1, 4), F.concat(F.lit("weak_product_signals="), signals)),
        (market, "marketplace_or_seller_terms_detected"),
    )
    ladder = (
        (F.col("_block"), "block_or_challenge_page", F.lit(90)),
        (category, "category_or_search_or_non_product_page", F.when(signals < 5, 80).otherwise(60)),
        (detail, "product_detail_page", F.least(F.lit(95), 60 + 5 * signals)),
        (real | (signals > 0), "ambiguous_product_page", 45 + F.least(4 * signals, F.lit(25))),
    )
    status, confidence = F.lit("unknown_or_thin_page"), F.lit(25)
    for condition, name, sure in reversed(ladder):
        status = F.when(condition, name).otherwise(status)
        confidence = F.when(condition, sure).otherwise(confidence)
    return df.withColumns(
        {
            "page_classification_status": status,
            "page_classification_confidence": confidence.cast("int"),
            "page_classification_reasons": F.array_join(reasons, "; "),
            "is_product_detail_page": detail,
            "is_category_or_search_page": category,
            "is_marketplace_page": market,
            "is_block_or_challenge_page": F.col("_block"),
        }
    ).drop("_blob", "_signals", "_hits", "_block", "_listing", "_other", "_real")


def normal_role(c: Column | str) -> Column:
    role = F.translate(F.lower(F.trim(filled(c))), "- ", "__")
    return F.coalesce(F.nullif(role, F.lit("")), F.lit("unknown"))


def align_sources(rows: DataFrame) -> DataFrame:
    """Add retailer_match and country_match (null: not comparable), alignment_status and what may be claimed.

    rows: requested_retailer_name, requested_country_code, source_retailer_name,
    source_country_code, source_url_role.
    """
    asked, found = normal_name("requested_retailer_name"), normal_name("source_retailer_name")
    want, have = F.upper(F.trim(filled("requested_country_code"))), F.upper(F.trim(filled("source_country_code")))
    df = rows.withColumns(
        {
            "_role": normal_role("source_url_role"),
            "retailer_match": F.when((asked != "") & (found != ""), asked == found),
            "country_match": F.when((want != "") & (have != ""), want == have),
        }
    )
    both = F.coalesce("retailer_match", F.lit(False)) & F.coalesce("country_match", F.lit(False))
    either = ~F.coalesce("retailer_match", F.lit(True)) | ~F.coalesce("country_match", F.lit(True))
    status = (
        F.when(F.col("_role").isin(*vocab.PRIMARY_ROLES), "primary_requested_source")
        .when(F.col("_role").isin(*vocab.FALLBACK_ROLES), "fallback_source_used")
        .when(both, "primary_requested_source")
        .when(either, "source_context_mismatch")
        .otherwise("not_declared")
    )
    df = df.withColumn("alignment_status", status)
    primary = F.col("alignment_status") == "primary_requested_source"
    return df.withColumns(
        {
            "requested_retailer_claims_allowed": primary,
            "source_specific_claim_scope": F.when(primary, "requested_retailer_and_country").otherwise(
                "scraped_source_only"
            ),
        }
    ).drop("_role")

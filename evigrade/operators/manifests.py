"""What an artifact says of itself: metadata, images, tables and a manifest of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.functions.text import filled
from evigrade.operators.batch import relative_path

VERSION = "product_scrape.v9.result_image_semantics"


def metadata_payload() -> Column:
    """Head, structured data and capture facts of a graded row as one struct."""
    names = ("url", "final_url", "title", "description", "canonical_url", "og", "product_meta", "json_ld", "access_status",
             "proxy_used", "capture_score", "capture_grade", "capture_decision", "real_scrape_evidence")
    return F.struct(*names, F.col("fetch_profile").alias("capture_profile_used"), F.size("json_ld").alias("json_ld_count"))


def image_manifest(rows: DataFrame, base: str = "", key: str = "scrape_id") -> DataFrame:
    """One row for each image of a request, numbered from 1, with its path below the artifact's folder."""
    found = rows.select(key, F.posexplode("images").alias("i", "image"))
    path = relative_path(F.col("image.local_path"), base) if base else filled("image.local_path")
    return found.select(key, (F.col("i") + 1).alias("index"), path.alias("path"), "image.alt", "image.relevance", "image.description")


def table_manifest(rows: DataFrame, key: str = "scrape_id") -> DataFrame:
    """One row for each table; the index keeps the table's place in the page."""
    found = rows.select(key, F.explode("tables").alias("t"))
    path = F.format_string("tables/table_%03d.md", F.col("t.index"))
    return found.select(key, F.col("t.index").alias("index"), "t.caption", F.col("t.n_rows").alias("rows"), F.col("t.n_columns").alias("cols"), path.alias("path"))


def artifact_manifest() -> Column:
    """The manifest of a graded row: identity, files' counts and the gate's verdict."""
    counts = F.struct(
        F.size("images").alias("image_candidates"),
        "image_downloaded_count",
        "clean_product_image_count",
        "vision_described_count",
        "table_count",
        "json_ld_count",
        "n_claims",
        "product_text_chars",
        "visual_evidence_status",
    )
    gate = F.struct(F.col("artifact_quality").alias("quality_gate"), "quality_score", "requires_manual_review", "visual_evidence_status")
    context = F.struct("main_text", "ean", F.col("requested_retailer_name").alias("retailer_name"), F.col("requested_country_code").alias("country_code"))
    return F.struct(
        F.lit(VERSION).alias("artifact_version"),
        "scrape_id",
        context.alias("input_context"),
        "product_url",
        F.lit(True).alias("product_only_artifact"),
        "access_status",
        "browser_visible",
        counts.alias("counts"),
        gate.alias("quality"),
    )

"""Audits of artifact folders, from a listing of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.functions.text import filled

# --- fixed values: the files of an artifact ---
ROOT_FILES = ("request.json", "scrape_result.json")
RETAILER_FILES = (
    "source.md",
    "product_evidence.json",
    "quality_report.json",
    "source_alignment_report.json",
    "vision.md",
)
MANIFEST_FILES = ("artifact_manifest.json", "image_manifest.json", "agent_trace.json")
READY_VISUAL = "final_product_images_available"
_IMAGE = r"(?i)\.(?:jpg|jpeg|png|webp|gif|bmp)$"


def required_files(label: str = "retailer") -> list[str]:
    return [*ROOT_FILES, *[f"{label}/{f}" for f in RETAILER_FILES], *[f"{label}/manifests/{f}" for f in MANIFEST_FILES]]


def audit_artifacts(files: DataFrame, label: str = "retailer") -> DataFrame:
    """One row for each artifact: its status and whether it is ready.

    files: scrape_id, rel_path, size, text (of the JSON files and vision.md).  One
    aggregate over the listing; nothing is joined.
    """
    path, text, size = F.col("rel_path"), filled("text"), F.col("size")
    pick = lambda name: F.max(F.when(path == name, text))
    required = required_files(label)
    vision = f"{label}/vision.md"
    found = files.groupBy("scrape_id").agg(
        F.collect_set(F.when(path.isin(*required), path)).alias("_there"),
        F.collect_set(F.when(path.isin(*required) & (size == 0), path)).alias("_empty"),
        F.coalesce(F.bool_or(path == "_COMPLETE.json"), F.lit(False)).alias("_complete"),
        F.coalesce(F.bool_or(path == "_FAILED.json"), F.lit(False)).alias("_failed"),
        F.count_if(path.startswith(f"{label}/images/") & path.rlike(_IMAGE)).alias("image_file_count"),
        pick("scrape_result.json").alias("_result"),
        pick(f"{label}/quality_report.json").alias("_quality"),
        pick(f"{label}/manifests/artifact_manifest.json").alias("_manifest"),
        pick("_FAILED.json").alias("_error"),
        F.coalesce(F.bool_or((path == vision) & (F.trim(text) != "")), F.lit(False)).alias("_seen"),
    )
    get = lambda c, p: F.nullif(F.get_json_object(c, p), F.lit(""))
    review = F.coalesce(get("_result", "$.requires_manual_review"), get("_quality", "$.requires_manual_review"), F.lit("true"))
    df = found.withColumns(
        {
            "terminal_marker": F.when(F.col("_complete"), "_COMPLETE.json").when(F.col("_failed"), "_FAILED.json").otherwise(""),
            "missing_files": F.filter(F.array(*map(F.lit, required)), lambda f: ~F.array_contains("_there", f)),
            "empty_files": F.array_sort("_empty"),
            "vision_md_empty": ~F.col("_seen"),
            "visual_evidence_status": F.coalesce(
                get("_result", "$.visual_evidence_status"),
                get("_manifest", "$.quality.visual_evidence_status"),
                get("_manifest", "$.counts.visual_evidence_status"),
                F.lit(""),
            ),
            "artifact_quality": F.coalesce(
                get("_result", "$.artifact_quality"), get("_quality", "$.artifact_quality"), get("_manifest", "$.quality.quality_gate"), F.lit("")
            ),
            "requires_manual_review": F.lower(review) != "false",
            "manual_review_bucket": F.coalesce(get("_result", "$.manual_review_bucket"), F.lit("")),
            "error": F.coalesce(get("_result", "$.error"), get("_error", "$.error"), F.lit("")),
        }
    )
    invalid = (F.size("missing_files") > 0) | (F.size("empty_files") > 0) | F.col("vision_md_empty")
    unseen = (F.col("visual_evidence_status") != READY_VISUAL) | (F.col("image_file_count") < 1)
    ready = (
        (F.col("terminal_marker") == "_COMPLETE.json")
        & ~invalid
        & ~unseen
        & ~F.col("requires_manual_review")
        & F.col("artifact_quality").isin("strong", "usable")
    )
    status = (
        F.when(F.col("terminal_marker") == "", "incomplete_no_terminal_marker")
        .when(F.col("terminal_marker") == "_FAILED.json", "failed_finalized")
        .when(invalid, "complete_but_artifact_files_invalid")
        .when(unseen, "complete_but_visual_not_ready")
        .when(F.col("requires_manual_review"), "complete_but_manual_review_required")
        .when(ready, "ready_for_coding")
        .otherwise("complete_but_needs_review")
    )
    df = df.withColumns({"artifact_status": status, "ready_for_coding": ready})
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def audit_summary(audited: DataFrame) -> DataFrame:
    """(artifact_status, n, ready, images) for each status."""
    return audited.groupBy("artifact_status").agg(
        F.count("*").alias("n"), F.count_if("ready_for_coding").alias("ready"), F.sum("image_file_count").alias("images")
    )

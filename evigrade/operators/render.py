"""Markdown views of evidence, sources, images and readiness.  Fixed texts stand under vocab's marks or here as headings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import axes_cell, filled, markdown_cell, refs_cell


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[filled(c.cast("string")) for c in cells]), F.lit(" |"))


def claim_table(title: str, claims: Column | str) -> Column:
    """A section with a numbered table of claims, or a line saying that there is none."""
    rows = F.transform(
        claims,
        lambda c, i: _row(
            (i + 1).cast("string"),
            markdown_cell(F.coalesce(F.nullif(c["attribute"], F.lit("")), F.lit("claim")), 120),
            markdown_cell(c["value"], 420),
            axes_cell(c["evidence_axis"]),
            c["confidence"],
            F.when(F.size(c["source_refs"]) > 0, refs_cell(c["source_refs"])).otherwise(markdown_cell(c["source"], 360)),
        ),
    )
    head = _lines("| # | Attribute | Claim / Value | Evidence axes | Confidence | Source refs / notes |", "|---:|---|---|---|---|---|")
    none = _lines("| Status | Detail |", "|---|---|", "| Not captured | No product-specific claim found in this evidence axis. |")
    return _lines(f"## {title}", "", F.when(F.size(claims) > 0, _lines(head, F.array_join(rows, "\n"))).otherwise(none), "")


def evidence_markdown() -> Column:
    """The evidence of a build_evidence() row: identity, then every list of claims."""
    facts = F.transform(
        "product_identity",
        lambda f: _row(
            markdown_cell(f["key"], 120),
            markdown_cell(F.coalesce(F.nullif(f["value"], F.lit("")), F.lit("(missing)")), 260),
            axes_cell(f["evidence_axis"]),
            f["confidence"],
            refs_cell(f["source_refs"]),
        ),
    )
    identity = _lines(
        "## Identity decision table",
        "",
        "| Field | Value | Evidence axes | Confidence | Source refs |",
        "|---|---|---|---|---|",
        F.array_join(facts, "\n"),
        "",
    )
    sections = [claim_table(name.replace("_", " ").capitalize(), name) for name in vocab.CLAIM_LISTS]
    return _lines("# Product Evidence Dossier", "", identity, *sections)


def source_markdown() -> Column:
    """The product-only text blocks of a build_evidence() row as a table."""
    blocks = F.transform(
        "product_only_text_blocks",
        lambda b, i: _row(
            (i + 1).cast("string"), markdown_cell(b["heading"], 180), axes_cell(b["evidence_axis"]), markdown_cell(b["content"], 900)
        ),
    )
    none = _row(F.lit("1"), F.lit("Not captured"), F.lit(""), F.lit("No normalized product-only text block was produced."))
    body = F.when(F.size("product_only_text_blocks") > 0, F.array_join(blocks, "\n")).otherwise(none)
    head = _lines("| # | Section | Evidence axes | Product-only extracted text |", "|---:|---|---|---|")
    return _lines("# Product-only Source Evidence", "", head, body)


def visual_markdown() -> Column:
    """The visual decision of a visual_decision() row as a table."""
    rows = (
        ("Visual evidence status", "visual_evidence_status"),
        ("Image candidates found", "image_candidate_count"),
        ("Images retained", "image_downloaded_count"),
        ("Clean product-gallery images", "clean_product_image_count"),
        ("Vision-described images", "vision_described_count"),
        ("Screenshot fallback used", "screenshot_fallback_used"),
        ("Image download/recovery errors", "image_download_errors"),
    )
    return _lines("# Visual Evidence Summary", "", "| Field | Value |", "|---|---|", *[_row(F.lit(label), F.col(c)) for label, c in rows])


def readiness_markdown() -> Column:
    """Coding readiness and its features; columns of coding_readiness(), and features: array of (feature, status)."""
    rows = (
        ("Ready for coding", "ready_for_coding"),
        ("Recommended action", "recommended_downstream_action"),
        ("Identity status", "identity_status"),
        ("Main-text match score", "main_text_match_score"),
        ("Artifact quality", "artifact_quality"),
    )
    features = F.array_join(F.transform("features", lambda f: _row(markdown_cell(f["feature"]), f["status"])), "\n")
    return _lines(
        "## Downstream Product-Coding Readiness",
        "",
        "| Field | Value |",
        "|---|---|",
        *[_row(F.lit(label), F.col(c)) for label, c in rows],
        "",
        "### Feature Evidence Readiness",
        "",
        "| Feature hint | Status |",
        "|---|---|",
        features,
    )

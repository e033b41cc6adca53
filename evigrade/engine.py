"""The way from requests and captures to graded results.

Pages, images and model replies come in as tables; everything between is one plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evigrade.config import Settings
from evigrade.functions.text import filled
from evigrade.functions.urls import domain
from evigrade.operators import batch, capture, classify, evidence, images, quality, readiness, validate
from evigrade.session import cut
from evigrade.sieve import sifted
from evigrade.sources import batch_csv, sinks

_NOTHING = "array<struct<local_path:string,alt:string,relevance:string,description:string,download_source:string,error:string>>"
_TABLES = "array<struct<index:int,caption:string,n_rows:int,n_columns:int,markdown:string>>"


def within_limits(image_rows: DataFrame, requests: DataFrame) -> DataFrame:
    """The first max_images images of each request, by ordinal; images of no request go."""
    first = Window.partitionBy("scrape_id").orderBy("ordinal", "local_path")
    met = image_rows.join(requests.select("scrape_id", F.col("max_images").alias("_most")), "scrape_id")
    return met.withColumn("_at", F.row_number().over(first)).where("_at <= _most").drop("_at", "_most")


def grade(
    requests: DataFrame, captures: DataFrame, image_rows: DataFrame | None = None, settings: Settings | None = None
) -> DataFrame:
    """One graded row for every request: its best capture, evidence, recovery, quality gate; requests without a capture failed.

    requests: as batch.requests_from_rows() gives them.  captures: scrape_id, ordinal, fetch_profile,
    url, final_url, title, description, canonical_url, raw_markdown, raw_html, access_status,
    access_issue_type, success, proxy_used, json_ld (array of text), og, product_meta (maps) and tables.
    image_rows: scrape_id, ordinal, local_path, alt, relevance, description, download_source, error.
    settings: only so many profiles are looked at, the score that ends the search is theirs, and a request has
    max_images images at most; without settings all captures and images count and the search ends at the default score.
    """
    stop_score = capture.EARLY_STOP_SCORE
    if settings is not None:
        stop_score = settings.scrape_early_stop_score
        captures = captures.where(F.col("ordinal") < settings.scrape_profile_max_profiles)
        image_rows = within_limits(image_rows, requests) if image_rows is not None else None
    asked = requests.select("scrape_id", "main_text", "ean")
    pages = captures.withColumns(
        {
            "n_json_ld": F.size("json_ld"),
            "n_tables": F.size("tables"),
            "n_og": F.size("og"),
            "n_meta": F.size("product_meta"),
            "n_images": F.coalesce("n_images", F.lit(0)) if "n_images" in captures.columns else F.lit(0),
        }
    )
    chosen = cut(capture.best_of(capture.scored_until_enough(pages, asked, stop_score), early_stop=True, stop_score=stop_score))
    # pages are measured before they meet the choice, and most others dropped
    key = F.xxhash64("scrape_id", "ordinal")
    best = evidence.page_signals(sifted(pages.drop(*chosen.columns[2:]), key, chosen, key)).join(chosen, ["scrape_id", "ordinal"])
    tried = pages.groupBy("scrape_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "fetch_profile"))), lambda p: p["fetch_profile"]).alias("capture_profiles_attempted"))
    if image_rows is not None:
        one = F.struct("ordinal", "local_path", "alt", "relevance", "description", "download_source", "error")
        held = image_rows.groupBy("scrape_id").agg(F.array_sort(F.collect_list(one)).alias("images"))
        visual = images.visual_decision(image_rows.withColumn("retained", filled("local_path") != ""))
    else:
        held = requests.select("scrape_id", F.array().cast(_NOTHING).alias("images")).limit(0)
        visual = None
    rows = requests.join(best, "scrape_id", "left").join(tried, "scrape_id", "left").join(held, "scrape_id", "left")
    if visual is not None:
        rows = rows.join(visual, "scrape_id", "left")
    none = held.schema["images"].dataType
    rows = batch.with_defaults(
        rows.withColumn("created", F.col("ordinal").isNotNull()),
        {"access_status": "not_attempted", "n_json_ld": 0, "n_tables": 0, "n_og": 0, "n_meta": 0, "n_images": 0, "proxy_used": False,
         "success": False, "capture_score": 0, "real_scrape_evidence": False, "capture_grade": "not_evaluated",
         "capture_decision": "not_evaluated", "visual_evidence_status": "no_image_candidates"},
    )
    empty_map = F.from_json(F.lit("{}"), "map<string,string>")
    rows = rows.withColumns(
        {
            "images": F.coalesce("images", F.array().cast(none)),
            "tables": F.coalesce("tables", F.array().cast(_TABLES)),
            "json_ld": F.coalesce("json_ld", F.array().cast("array<string>")),
            "og": F.coalesce("og", empty_map),
            "product_meta": F.coalesce("product_meta", empty_map),
            "url": F.coalesce("url", "product_url"),
        }
    )
    rows = classify.align_sources(rows)
    rows = evidence.recovery_report(evidence.build_evidence(evidence.capture_health(rows)))
    kept = F.filter("images", lambda i: filled(i["local_path"]) != "")
    shot = lambda i: filled(i["download_source"]) == "screenshot_fallback"
    parts = ["product_identity", "product_only_text_blocks", *evidence.vocab.CLAIM_LISTS]
    rows = rows.withColumns(
        {
            "evidence_text": F.to_json(F.struct(*parts)),
            "page_title": F.col("title"),
            "n_retailer_claims": F.size("retailer_claims"),
            "n_structured": F.col("n_tables") + F.col("n_json_ld") + F.col("n_og") + F.col("n_meta") + F.size("structured_claims"),
            "n_images": F.size("images"),
            "n_downloaded": F.size(kept),
            "n_clean": F.size(F.filter(kept, lambda i: (F.lower(filled(i["relevance"])) == "yes") & ~shot(i))),
            "n_screenshots": F.size(F.filter(kept, shot)),
            "n_described": F.size(F.filter(kept, lambda i: filled(i["description"]) != "")),
            "n_errors": F.size(F.filter("images", lambda i: filled(i["error"]) != "")),
            "n_forbidden": F.size(F.filter("images", lambda i: F.contains(filled(i["error"]), F.lit("403")))),
            "n_axes": F.size("evidence_axes_used"),
            "image_required": F.lit(True),
            "weak_capture": F.col("weak_health"),
            "browser_visible": F.col("browser_product_visible"),
            "has_upstream": evidence.has_upstream(),
            **evidence.claim_counts(),
        }
    )
    graded = batch.public_results(quality.quality_gate(rows))
    return graded.withColumns(
        {
            "success": F.col("created") & F.col("product_details_recovered"),
            "input_id": F.col("scrape_id"),
            "capture_profile_used": F.col("fetch_profile"),
            "weak_capture_reasons": F.array_join("health_reasons", "; "),
            "source_alignment_status": F.col("alignment_status"),
            "source_claim_scope": F.col("source_specific_claim_scope"),
            "error": F.when(F.col("created"), "").otherwise("no capture for this request"),
            "image_failure_reason": F.when(F.col("n_clean") > 0, "").otherwise(F.col("visual_evidence_status")),
        }
    )


def enrich_artifacts(evidence_rows: DataFrame, metadata: DataFrame, quality_rows: DataFrame) -> DataFrame:
    """Evidence with its metadata and quality report, verified identity and coding readiness.

    All by scrape_id; evidence_rows: main_text, product_title, ean, ean_detected.  The quality report's columns
    win over those of the metadata.  Running it again changes nothing.
    """
    shared = [c for c in metadata.columns if c in quality_rows.columns and c != "scrape_id"]
    report = quality_rows.select("scrape_id", *[F.col(c).alias(f"_q_{c}") if c in shared else F.col(c) for c in quality_rows.columns if c != "scrape_id"])
    df = evidence_rows.join(metadata, "scrape_id", "left").join(report, "scrape_id", "left")
    df = df.withColumns({c: F.coalesce(f"_q_{c}", c) for c in shared}).drop(*[f"_q_{c}" for c in shared])
    return readiness.coding_readiness(readiness.verify_identity(df))


def enrichment_counts(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row: artifacts, changed ones and changed cells; rows are matched by key."""
    old = before.select(*key, *[F.col(c).alias(f"_old_{c}") for c in columns if c in before.columns])
    met = after.join(old, key, "left")
    changed = sum((~F.col(c).eqNullSafe(F.col(f"_old_{c}") if c in before.columns else F.lit(None))).cast("int") for c in columns)
    met = met.withColumn("_changed", changed)
    return met.agg(F.count("*").alias("artifacts"), F.count_if(F.col("_changed") > 0).alias("changed"), F.coalesce(F.sum("_changed"), F.lit(0)).alias("changed_cells"))


@dataclass
class Batch:
    """A run over one input: what it reads, where it writes, and its settings."""

    spark: SparkSession
    input_csv: str
    output_csv: str
    summary_json: str = ""
    settings: Settings = field(default_factory=Settings)

    def requests(self) -> tuple[DataFrame, DataFrame]:
        """Requests with unique ids, and rows without a URL."""
        rows = batch_csv.read_batch_csv(self.spark, self.input_csv)
        good, bad = batch.requests_from_rows(batch.unique_ids(rows, batch.first_filled(rows, batch.vocab.ALIASES["input_id"]), ["row_number"]), settings=self.settings)
        return good, bad

    def run(self, captures: DataFrame, image_rows: DataFrame | None = None, resume: bool = False) -> DataFrame:
        """Grade the input, append its 66 columns to the output, write the summary; returns the rows written."""
        good, bad = self.requests()
        if resume:
            done = batch_csv.completed_ids(self.spark, self.output_csv).withColumnRenamed("input_id", "scrape_id")
            good = good.join(done, "scrape_id", "left_anti")
        rows = batch.result_rows(grade(good, captures, image_rows, self.settings))
        refused = bad.withColumns({"created": F.lit(False), "input_id": F.col("scrape_id"), "error": F.lit("Missing required product_url/url column value")})
        rows = rows.unionByName(batch.result_rows(classify.align_sources(refused).withColumn("source_alignment_status", F.col("alignment_status"))))
        sinks.write_csv(rows, self.output_csv, "append" if resume else "overwrite")
        written = self.spark.read.options(header=True, multiLine=True, escape='"').csv(self.output_csv)
        if self.summary_json:
            sinks.write_json(self.spark, self.summary_json, batch.batch_summary(written).first())
        return written


def triage(results: DataFrame, image_rows: DataFrame, texts: tuple[str, ...] = ()) -> DataFrame:
    """Business columns, then page classes, then image diagnostics, each replacing columns of the same name; and the priority.

    results: result rows with scrape_id; image_rows: scrape_id, ordinal, local_path, error, attempts.
    """
    rows = classify.classify_pages(validate.validate_rows(results, texts))
    rows = images.image_diagnostics(rows.drop(*images.DIAGNOSTICS), image_rows)
    bucket = F.coalesce(F.nullif(filled("manual_review_bucket"), F.lit("")), F.lit("REVIEW_REQUIRED_BY_QUALITY_GATE"))
    return rows.withColumns({"triage_bucket": bucket, "triage_priority": validate.triage_priority(bucket)})


def site_of(results: DataFrame) -> DataFrame:
    """Add the domain of each result's page."""
    return results.withColumn("domain", domain(F.coalesce(F.nullif(filled("final_url"), F.lit("")), filled("product_url"))))

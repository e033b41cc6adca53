"""Batches: input rows, duplicate ids, resume, results and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evigrade.config import Settings
from evigrade.functions import vocab
from evigrade.functions.text import digits_only, empty_to_null, filled, int_or, is_true, split_snippets, stable_id, tri_state
from evigrade.operators.capture import capture_flags
from evigrade.operators.classify import normal_role
from evigrade.sources.evidence import evidence_items


def first_filled(rows: DataFrame, names: tuple[str, ...], default: str = "") -> Column:
    """The first non-empty of several columns, exact names first and then any case; cells of blanks are empty."""
    exact = [c for n in names for c in rows.columns if c == n]
    loose = [c for n in names for c in rows.columns if c.lower() == n.lower() and c not in exact]
    found = [empty_to_null(F.col(f"`{c}`").cast("string")) for c in [*exact, *loose]]
    return F.coalesce(*found, F.lit(default))


def requests_from_rows(
    rows: DataFrame, row_number: Column | str = "row_number", settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Normalised requests, and the rows that have no URL.

    Cells that may name files (upstream_ai_evidence, upstream_ai_evidence_file and search_evidence)
    are taken as texts; batch_csv.inline_or_file() replaces names before.
    """
    get = lambda name, default="": first_filled(rows, vocab.ALIASES.get(name, (name,)), default)
    number = F.col(row_number) if isinstance(row_number, str) else row_number
    retailer, country = get("retailer_name"), get("country_code")
    either = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), b)
    made = rows.select(
        number.alias("row_number"),
        get("product_url").alias("product_url"),
        either(get("scrape_id"), stable_id(get("input_id"), number)).alias("scrape_id"),
        get("main_text").alias("main_text"),
        digits_only(get("ean")).alias("ean"),
        either(get("requested_retailer_name"), retailer).alias("requested_retailer_name"),
        F.upper(either(get("requested_country_code"), country)).alias("requested_country_code"),
        get("source_retailer_name").alias("source_retailer_name"),
        F.upper(get("source_country_code")).alias("source_country_code"),
        normal_role(get("source_url_role", "unknown")).alias("source_url_role"),
        get("product_hint").alias("product_hint"),
        split_snippets(get("candidate_snippets")).alias("candidate_snippets"),
        int_or(get("max_images"), settings.max_images).alias("max_images"),
        int_or(get("vision_max"), settings.vision_max).alias("vision_max"),
        int_or(get("max_agent_iterations"), settings.max_agent_iterations).alias("max_agent_iterations"),
        tri_state(get("write_raw_debug")).alias("write_raw_debug"),
        get("retailer_label", "retailer").alias("retailer_label"),
        F.concat_ws(
            "\n\n", empty_to_null(get("upstream_ai_evidence")), empty_to_null(get("upstream_ai_evidence_file"))
        ).alias("ai_mode_evidence"),
        evidence_items(get("search_evidence")).alias("search_evidence"),
        get("upstream_evidence_notes").alias("upstream_evidence_notes"),
    )
    return made.where("product_url <> ''"), made.where("product_url = ''")


def compact_hint() -> Column:
    """Main text, EAN, retailer and country in one line."""
    parts = ("main_text", "ean", "requested_retailer_name", "requested_country_code")
    return F.concat_ws(" | ", *[empty_to_null(p) for p in parts])


def unique_ids(rows: DataFrame, raw_id: Column, order: list[Column | str]) -> DataFrame:
    """Give repeated explicit ids a suffix, and say what was done.

    Adds input_id, original_input_id, input_id_duplicate_count, input_id_duplicate_index
    and input_id_collision_resolved.  Blank ids are exempt: they get the row's own.
    Needs row_number; order is the total order in which repeats are counted.
    """
    df = rows.withColumn("_raw", filled(raw_id)).withColumn("_sid", stable_id("_raw", "row_number"))
    explicit = F.col("_raw") != ""
    group = Window.partitionBy("_sid", explicit)
    df = df.withColumns(
        {
            "_n": F.when(explicit, F.count("*").over(group)).otherwise(1),
            "_k": F.when(explicit, F.row_number().over(group.orderBy(*order))).otherwise(1),
        }
    )
    again = F.col("_k") > 1
    name = F.when(again, F.format_string("%s__DUP%02d", "_sid", "_k")).otherwise(F.col("_sid"))
    return df.withColumns(
        {
            "original_input_id": F.when(explicit, F.col("_raw")).otherwise(F.col("_sid")),
            "input_id": name,
            "input_id_duplicate_count": F.col("_n").cast("int"),
            "input_id_duplicate_index": F.col("_k").cast("int"),
            "input_id_collision_resolved": again,
        }
    ).drop("_raw", "_sid", "_n", "_k")


def duplicate_report(resolved: DataFrame) -> DataFrame:
    """One row: total_rows, duplicate_groups, duplicate_rows, changed."""
    n, k = F.col("input_id_duplicate_count"), F.col("input_id_duplicate_index")
    return resolved.agg(
        F.count("*").alias("total_rows"),
        F.count_if((n > 1) & (k == 1)).alias("duplicate_groups"),
        F.count_if(n > 1).alias("duplicate_rows"),
        (F.count_if(n > 1) > 0).alias("changed"),
    )


def still_to_do(requests: DataFrame, results: DataFrame, id_col: str = "input_id") -> DataFrame:
    """Requests without a successful result.  Which side is broadcast is left to its measured size."""
    done = results.where(is_true("success")).select(id_col).distinct()
    return requests.join(done, id_col, "left_anti")


def batch_summary(results: DataFrame) -> DataFrame:
    """One row: totals, successes, failures, reviews and, as a map, how many rows have each artifact_quality.

    The histogram needs artifact_quality; without the column it is empty.
    """
    ok = is_true("success")
    known = "artifact_quality" in results.columns
    quality = F.coalesce(F.nullif(filled("artifact_quality"), F.lit("")), F.lit("not_evaluated")) if known else F.lit("")
    counts = results.groupBy(quality.alias("quality")).agg(
        F.count("*").alias("n"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(is_true("requires_manual_review")).alias("needs_review"),
    )
    histogram = F.map_from_entries(F.array_sort(F.collect_list(F.struct("quality", "n"))))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("succeeded"), F.lit(0)).alias("succeeded"),
        F.coalesce(F.sum(F.col("n") - F.col("succeeded")), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("needs_review"), F.lit(0)).alias("needs_review"),
        (histogram if known else F.from_json(F.lit("{}"), "map<string,bigint>")).alias("quality_counts"),
    )


def finish_rows(requests: DataFrame, results: DataFrame, defaults: dict[str, object], id_col: str = "scrape_id") -> DataFrame:
    """Every request with a result; those without get the defaults of a failure."""
    joined = requests.join(results, id_col, "left")
    return joined.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def flat_row(results: DataFrame, columns: list[str]) -> DataFrame:
    """Results in the fixed column order of the output, lists joined with "; ", absent columns empty."""
    return results.select(*_flat_columns(results, columns))


def _flat_columns(results: DataFrame, columns: list[str]) -> list[Column]:
    kinds = dict(results.dtypes)
    out = []
    for name in columns:
        if name not in kinds:
            out.append(F.lit("").alias(name))
        elif kinds[name].startswith("array"):
            out.append(F.array_join(F.col(name).cast("array<string>"), "; ").alias(name))
        else:
            out.append(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name))
    return out


def result_rows(results: DataFrame) -> DataFrame:
    """Results in the 66 columns of the batch output, all text.

    results: what finish_rows() or run_batch() gives; `created` false marks requests for
    which no artifact was made, whose row has the fixed values of vocab.NOT_CREATED and the error as
    its image_failure_reason.  Flags are derived where they are absent.
    """
    have = set(results.columns)
    made = F.coalesce(F.col("created"), F.lit(True)) if "created" in have else F.lit(True)
    flags = {n: c.cast("string") for n, c in capture_flags().items()} if "capture_decision" in have else {}
    if "real_scrape_evidence" in have:
        flags["has_real_scrape_evidence"] = F.col("real_scrape_evidence").cast("string")
    df = results.withColumns({n: c for n, c in flags.items() if n not in have})
    flat = dict(zip(vocab.RESULT_COLUMNS, _flat_columns(df, list(vocab.RESULT_COLUMNS))))
    asked = {"row_number", "input_id", "product_url", "main_text", "ean", "requested_retailer_name", "requested_country_code",
             "source_retailer_name", "source_country_code", "source_url_role", "source_alignment_status", "source_claim_scope",
             "requested_retailer_claims_allowed", "error"}
    out = []
    for name in vocab.RESULT_COLUMNS:
        empty = F.lit(vocab.NOT_CREATED.get(name, ""))
        if name == "image_failure_reason":
            empty = F.coalesce(F.nullif(flat["error"], F.lit("")), F.lit("row was not created"))
        out.append((flat[name] if name in asked else F.when(made, flat[name]).otherwise(empty)).alias(name))
    return df.select(*out)


def public_results(rich: DataFrame) -> DataFrame:
    """Rich results as public ones: image counters and the quality gate's verdict are lifted to the top.

    rich: images (array with local_path, description, relevance, download_source), tables,
    json_ld, and the columns of quality_gate().
    """
    kept = F.filter("images", lambda i: filled(i["local_path"]) != "")
    clean = F.filter(kept, lambda i: (F.lower(filled(i["relevance"])) == "yes") & (filled(i["download_source"]) != "screenshot_fallback"))
    return rich.withColumns(
        {
            "image_candidate_count": F.size("images"),
            "image_downloaded_count": F.size(kept),
            "final_image_count": F.size(kept),
            "clean_product_image_count": F.size(clean),
            "vision_described_count": F.size(F.filter(kept, lambda i: filled(i["description"]) != "")),
            "screenshot_fallback_used": F.exists(kept, lambda i: filled(i["download_source"]) == "screenshot_fallback"),
            "table_count": F.size("tables"),
            "json_ld_count": F.size("json_ld"),
        }
    )


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are absent or null get their default; what is there stays."""
    have = set(rows.columns)
    return rows.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in have else F.lit(v) for k, v in defaults.items()})


def union_columns(*tables: DataFrame) -> DataFrame:
    """All rows; columns in the order in which they are first seen, absent cells empty."""
    names = list(dict.fromkeys(c for t in tables for c in t.columns))
    filled_up = [t.select(*[filled(F.col(c).cast("string")).alias(c) if c in t.columns else F.lit("").alias(c) for c in names]) for t in tables]
    out = filled_up[0]
    for t in filled_up[1:]:
        out = out.unionByName(t)
    return out


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """(value, n): how often each value occurs, null too."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def prompt_block() -> Column:
    """What was asked for, a line for each part that is there."""
    parts = (("Product text", "main_text"), ("EAN/GTIN", "ean"), ("Retailer", "requested_retailer_name"), ("Country", "requested_country_code"))
    return F.concat_ws("\n", *[F.when(filled(c) != "", F.concat(F.lit(f"- {label}: "), F.col(c))) for label, c in parts])


def output_dir(root: str) -> Column:
    """Where a request's artifact belongs: root, its id and its label."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), "scrape_id", "retailer_label")


def relative_path(path: Column | str, base: str) -> Column:
    """A path below a base; other paths as they are, null as empty."""
    p, stem = filled(path), base.rstrip("/") + "/"
    return F.when(p.startswith(stem), F.substr(p, F.lit(len(stem) + 1))).otherwise(p)

"""What a batch leaves behind: tables as CSV, summaries as JSON, markers.

Tables are written by Spark's commit protocol, so a reader sees all of a
write or nothing.  Small documents are written by the driver under another
name and renamed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import PurePath
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import filled
from evigrade.operators.audit import audit_summary
from evigrade.operators.batch import result_rows
from evigrade.operators.validate import triage_order, triage_summary, validate_rows

TRIAGE_DIMENSIONS = ("manual_review_bucket", "visual_evidence_status", "page_classification_status", "image_failure_bucket")


def to_jsonable(value: Any) -> Any:
    """Rows and mappings as objects, sequences and sets as lists, paths as texts; sets are sorted."""
    if isinstance(value, Row):
        value = value.asDict(recursive=True)
    if isinstance(value, Mapping):
        return {str(k): to_jsonable(v) for k, v in value.items()}
    if isinstance(value, (set, frozenset)):
        return sorted(map(to_jsonable, value), key=str)
    if isinstance(value, (list, tuple)):
        return [to_jsonable(v) for v in value]
    if isinstance(value, (str, int, float, bool)) or value is None:
        return value
    return str(value.as_posix() if isinstance(value, PurePath) else value)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in whole or not at all: written beside its name, then renamed."""
    jvm = spark.sparkContext._jvm
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(beside, target):
        raise OSError(f"could not rename to {path}")


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(to_jsonable(value), ensure_ascii=False, indent=2) + "\n")


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All columns as text, lists joined with "; ", one header for each part."""
    flat = [
        F.array_join(F.col(c).cast("array<string>"), "; ").alias(c) if t.startswith("array") else filled(F.col(c).cast("string")).alias(c)
        for c, t in rows.dtypes
    ]
    rows.select(*flat).write.mode(mode).options(header=True, escape='"', emptyValue="").csv(path)


def append_result_rows(results: DataFrame, path: str) -> None:
    """Append to a batch output in its 66 columns."""
    write_csv(result_rows(results), path, "append")


def write_business_rows(rows: DataFrame, path: str, texts: tuple[str, ...] = ()) -> None:
    """Result rows with the business columns as a new output; the input is never overwritten."""
    write_csv(validate_rows(rows, texts), path)


def write_triage(rows: DataFrame, path: str, summary_path: str) -> None:
    """Triaged rows, most urgent first, and their four histograms as one JSON document."""
    have = tuple(c for c in TRIAGE_DIMENSIONS if c in rows.columns)
    write_csv(triage_order(rows), path)
    counts: dict[str, dict[str, int]] = {}
    for r in triage_summary(rows, have).collect():
        counts.setdefault(r["dimension"], {})[r["value"]] = r["n"]
    buckets = counts.get("manual_review_bucket", {})
    total, ready = sum(buckets.values()), buckets.get("READY_FOR_CODING", 0)
    write_json(rows.sparkSession, summary_path, {"total_rows": total, "ready_for_coding": ready, "needs_review": total - ready, **counts})


def write_audit(audited: DataFrame, path: str, summary_path: str) -> None:
    """Audit rows by scrape_id, and counts of each status as one JSON document."""
    write_csv(audited.orderBy("scrape_id"), path)
    found = {r["artifact_status"]: r["n"] for r in audit_summary(audited).collect()}
    ready = found.get("ready_for_coding", 0)
    write_json(audited.sparkSession, summary_path, {"total": sum(found.values()), "ready_for_coding": ready, "by_status": found})


def write_normalised_input(resolved: DataFrame, path: str) -> None:
    """Input rows after duplicate ids are resolved, in row order."""
    write_csv(resolved.orderBy("row_number"), path)


def table_artifact(table: Column) -> Column:
    """A table (index, caption, n_rows, n_columns, markdown) as a markdown document."""
    title = F.when(filled(table["caption"]) != "", F.concat(F.lit("# "), table["caption"], F.lit("\n")))
    shape = F.format_string("<!-- rows=%d cols=%d -->\n", table["n_rows"], table["n_columns"])
    body = F.concat(F.regexp_replace(filled(table["markdown"]), r"\s+$", ""), F.lit("\n"))
    return F.concat_ws("\n", title, shape, body)


def table_artifacts(pages: DataFrame, key: str = "scrape_id") -> DataFrame:
    """(key, path, text): a document for each table of a page."""
    rows = pages.select(key, F.explode("tables").alias("t"))
    return rows.select(key, F.format_string("tables/table_%03d.md", F.col("t.index")).alias("path"), table_artifact(F.col("t")).alias("text"))


def terminal_markers(results: DataFrame) -> DataFrame:
    """(scrape_id, path, text): _COMPLETE.json or _FAILED.json of each finished request, _IN_PROGRESS.json of the others."""
    done, error = F.col("created"), filled("error")
    name = F.when(done.isNull(), "_IN_PROGRESS.json").when(done, "_COMPLETE.json").otherwise("_FAILED.json")
    status = F.when(done.isNull(), "in_progress").when(done, "complete").otherwise("failed")
    text = F.to_json(F.struct(status.alias("status"), "scrape_id", F.when(~done, error).alias("error")))
    return results.select("scrape_id", name.alias("path"), text.alias("text"))


def write_raw_debug(captures: DataFrame, path: str) -> None:
    """The raw texts of captures whose request asks for them, as Parquet."""
    wanted = captures.where(F.coalesce("write_raw_debug", F.lit(False)))
    wanted.select("scrape_id", "ordinal", "raw_markdown", "raw_html").write.mode("overwrite").parquet(path)


def result_columns() -> list[str]:
    return list(vocab.RESULT_COLUMNS)

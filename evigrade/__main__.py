"""Command line: python -m evigrade {batch,triage,audit,preflight} ..."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from evigrade.config import Settings
from evigrade.engine import Batch
from evigrade.functions import vocab
from evigrade.operators import audit, batch, validate
from evigrade.session import apply_semantics
from evigrade.sources import artifacts, batch_csv, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="evigrade")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("batch", help="grade a batch from its captures")
    run.add_argument("input_csv"), run.add_argument("captures"), run.add_argument("output_csv")
    run.add_argument("--images", default=""), run.add_argument("--summary", default=""), run.add_argument("--resume", action="store_true")
    triage = commands.add_parser("triage", help="order a batch output by urgency")
    triage.add_argument("input_csv"), triage.add_argument("output_csv"), triage.add_argument("summary_json")
    check = commands.add_parser("audit", help="audit artifact folders")
    check.add_argument("root"), check.add_argument("output_csv"), check.add_argument("summary_json")
    check.add_argument("--label", default="retailer")
    unique = commands.add_parser("preflight", help="resolve repeated input ids")
    unique.add_argument("input_csv"), unique.add_argument("output_csv"), unique.add_argument("--fail-on-duplicates", action="store_true")
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(arguments)
    spark = apply_semantics(spark or SparkSession.builder.appName("evigrade").getOrCreate())
    if given.command == "batch":
        pictures = spark.read.parquet(given.images) if given.images else None
        Batch(spark, given.input_csv, given.output_csv, given.summary, Settings.from_environment()).run(spark.read.parquet(given.captures), pictures, given.resume)
    elif given.command == "triage":
        rows = batch_csv.read_batch_csv(spark, given.input_csv)
        sinks.write_triage(validate.triage_rows(rows), given.output_csv, given.summary_json)
    elif given.command == "audit":
        found = audit.audit_artifacts(artifacts.scan_artifacts(spark, given.root), given.label)
        sinks.write_audit(found, given.output_csv, given.summary_json)
    else:
        rows = batch_csv.read_batch_csv(spark, given.input_csv)
        resolved = batch.unique_ids(rows, batch.first_filled(rows, vocab.ALIASES["input_id"]), [F.col("row_number")])
        if given.fail_on_duplicates and batch.duplicate_report(resolved).first()["changed"]:
            print("repeated input ids")
            return 2
        sinks.write_normalised_input(resolved, given.output_csv)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

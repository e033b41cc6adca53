"""Batch CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigrade.functions.text import is_true


def read_batch_csv(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, empty ones as "", with row_number from 1 in file order.

    A batch file is a request list that one task reads in order; store it as Parquet for
    anything larger.  A file without a header is refused.
    """
    reader = spark.read.options(header=True, multiLine=True, escape='"', mode="PERMISSIVE", encoding="UTF-8")
    rows = reader.csv(path)
    if not rows.columns:
        raise ValueError("the batch file has no header")
    rows = rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])
    return rows.coalesce(1).withColumn("row_number", (F.monotonically_increasing_id() + 1).cast("int"))


def completed_ids(spark: SparkSession, path: str, id_col: str = "input_id") -> DataFrame:
    """Distinct ids that an earlier output has as successful; none if it can't be read."""
    try:
        rows = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
        return rows.where(is_true("success")).select(id_col).distinct()
    except Exception:  # noqa: BLE001  an unreadable output means that nothing is done yet
        return spark.createDataFrame([], f"{id_col} string")


def append_results(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Append rows in the fixed column order; other columns are left out."""
    known = set(rows.columns)
    ordered = [F.col(c) if c in known else F.lit("").alias(c) for c in columns]
    rows.select(*ordered).write.mode("append").options(header=True, escape='"').csv(path)


def inline_or_file(rows: DataFrame, column: str, files: DataFrame) -> DataFrame:
    """Replace cells that name a file by its text; files: path, text."""
    named = files.select(F.col("path").alias(column), F.col("text").alias("_text"))
    joined = rows.join(named, column, "left")
    return joined.withColumn(column, F.coalesce("_text", column)).drop("_text")

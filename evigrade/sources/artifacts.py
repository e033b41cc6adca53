"""Artifact folders as a table of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_FILES = r"\.(?:json|md)$"


def _markers(spark: SparkSession, root: str) -> DataFrame:
    """(scrape_id, rel_path, size, text) of files whose names begin with "_", which Spark's readers leave out.

    They are the terminal markers, small and at most a few for each artifact; the driver lists and reads them.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/_*.json")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for found in files.globStatus(pattern) or []:
        path = found.getPath()
        stream = files.open(path)
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        rows.append((path.getParent().getName(), path.getName(), found.getLen(), text))
    return spark.createDataFrame(rows, "scrape_id string, rel_path string, size long, text string")


def scan_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(scrape_id, rel_path, size, text): one row for each file below root's folders; text of JSON and markdown only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = root.rstrip("/").rpartition("/")[2]
    below = F.regexp_extract("path", rf"/{name}/(.*)$", 1)
    parts = files.withColumn("_below", below).where(F.col("_below").contains("/"))
    text = F.when(F.col("path").rlike(TEXT_FILES), F.decode("content", "UTF-8"))
    listed = parts.select(
        F.regexp_extract("_below", r"^([^/]+)/", 1).alias("scrape_id"),
        F.regexp_extract("_below", r"^[^/]+/(.*)$", 1).alias("rel_path"),
        F.col("length").alias("size"),
        text.alias("text"),
    )
    return listed.union(_markers(spark, root))


def json_object(text) -> object:
    """A JSON object as a variant; null for anything else."""
    value = F.try_parse_json(text)
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def json_value(text) -> object:
    """Any JSON as a variant; null for what can't be read."""
    return F.try_parse_json(text)


def strict_evidence(spark: SparkSession, path: str) -> DataFrame:
    """The items of one evidence JSON file, an array or an object with items; anything else is an error.

    Columns: those of an evidence item.  The file is a caller's own and small.
    """
    from evigrade.sources.evidence import ITEM

    text = spark.read.text(path, wholetext=True).first()
    value = spark.createDataFrame([(text[0] if text else "",)], "t string").select(F.try_parse_json("t").alias("v"))
    kind = value.select(F.schema_of_variant("v")).first()[0] or "VOID"
    shape = "$.items" if kind.startswith("OBJECT") else "$"
    items = value.select(F.try_variant_get("v", shape, f"array<{ITEM}>").alias("i"))
    if items.first()["i"] is None:
        raise ValueError(f"{path} holds no list of evidence items")
    return items.select(F.explode("i").alias("i")).select("i.*")


def with_texts(rows: DataFrame, files: DataFrame, columns: list[str], most: int = 120_000) -> DataFrame:
    """Rows with <column>_text for each column that names a file; files: path, text.  Unknown paths give an empty text.

    The rows' paths meet the files in one join, whatever the number of columns.
    """
    named = rows.withColumn("_row", F.monotonically_increasing_id())
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("path")) for c in columns])).alias("p")
    met = named.select("_row", pairs).select("_row", "p.*").where("path <> ''").join(files.select("path", F.left("text", F.lit(most)).alias("text")), "path")
    texts = met.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("_texts"))
    joined = named.join(texts, "_row", "left")
    found = {f"{c}_text": F.coalesce(F.try_element_at("_texts", F.lit(c)), F.lit("")) for c in columns}
    return joined.withColumns(found).drop("_row", "_texts")

"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of `documents`; further columns are left out.
Null and empty texts are clean, have no near duplicates and no personal data, are
never due in the mix and so are not packed.  Rows that repeat a doc_id are
documents of their own in every stage.  An empty table passes as an empty table.
"""

from __future__ import annotations

import functools
import time
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigrade.llm.minhash_dedup import drop_near_duplicates
from evigrade.llm.mixing import mix_documents
from evigrade.llm.packing import pack_documents
from evigrade.llm.surrogates import replace_pii
from evigrade.llm.toxicity import drop_toxic
from evigrade.session import at_release, cuts, load, release, shared_dir, spread

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows that a Python worker holds at once; their texts stand in its memory, and in the executor's, several times over.
BATCH_ROWS = 1000


#: Results of stages, when each was made, and the folders in the shared folder that it reads.
_made: list[tuple[weakref.ref, float, list[str]]] = []


def _written(spark: SparkSession, file: str) -> float:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(path).getModificationTime() / 1000


def _sweep(docs: DataFrame) -> None:
    """Remove what earlier stages left in the shared folder, unless docs read it.

    A result that nobody holds any more is done with; so is the only one that is held, if docs were written after it was made.
    """
    read = docs.inputFiles() if _made else []
    unread = [e for e in _made if not any(path.split(":", 1)[-1].lstrip("/") in file for path in e[2] for file in read)]
    held = [e for e in unread if e[0]() is not None]
    for entry in unread:
        later = len(held) == 1 and bool(read) and _written(docs.sparkSession, read[0]) > entry[1]
        if entry[0]() is None or later:
            release(docs.sparkSession, entry[2])
            _made.remove(entry)


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that notes what it leaves in the shared folder; a later one removes it once the result has been written and dropped.

    Stages may also be composed without a table between them: then the folders stay until release().
    """

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _sweep(docs)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        known = set(cuts())
        result = function(spark, docs, sf_dir)
        _made.append((weakref.ref(result), time.time(), [path for path in cuts() if path not in known]))
        return result

    return run


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null and empty texts stay."""
    return drop_toxic(docs, load(spark, sf_dir, "labels")).select(*COLUMNS)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8.

    Null and empty texts stay, all of them.
    """
    return drop_near_duplicates(docs).select(*COLUMNS)


@_stage
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates; a null text stays null and its n_chars is null."""
    replaced = replace_pii(docs)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order in which the sources' schedules ask for them; texts without words never."""
    return mix_documents(docs).select(*COLUMNS)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences; equal rows have pieces of their own."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: Tokens and learned scores are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spread(load(spark, sf_dir, "documents"))
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    result = STAGES[-1][1](spark, docs, sf_dir)
    at_release(folder)
    return result

"""A result stream: new requests only, rows flushed batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def request_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Requests as they arrive in a folder of Parquet files, each input id once.

    Ids are kept for the life of the query, as a resume set is.
    """
    return spark.readStream.schema(schema).parquet(path).dropDuplicates(["input_id"])


def write_results(
    requests: DataFrame, grade: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, id_col: str = "input_id"
) -> StreamingQuery:
    """Grade each micro-batch and append it once: a repeated batch replaces its own folder."""

    def append(batch: DataFrame, number: int) -> None:
        grade(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return requests.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

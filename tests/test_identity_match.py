"""Words are made before the join, and a table of one row group is dealt over the cores."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from evigrade import session
from evigrade.plans import catalogue

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_identity_words_are_made_before_the_join(spark):
    plan = _plan(catalogue.identity_match(spark, SMALL))
    assert plan.count("[^a-z0-9]+") == 1
    assert plan.index("Join") < plan.index("[^a-z0-9]+")


def test_one_row_group_is_dealt(spark, tmp_path):
    table = pa.table({"doc_id": list(range(4000)), "text": [f"text {i} " * 20 for i in range(4000)]})
    pq.write_table(table, str(tmp_path / "documents.parquet"), compression="none", use_dictionary=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        docs = session.load(spark, str(tmp_path), "documents")
        many = session.spread(docs, heavy=True).groupBy(F.spark_partition_id()).count().count()
        assert many >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

"""The functions that are no built-ins, by name for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from evigrade.functions.urls import join_url
from evigrade.operators.images import perceptual_hash


def register(spark: SparkSession) -> list[str]:
    """Make them callable from spark.sql(): perceptual_hash(pixels) and join_url(base, link)."""
    found = {"perceptual_hash": perceptual_hash, "join_url": join_url}
    for name, function in found.items():
        spark.udf.register(name, function)
    return sorted(found)

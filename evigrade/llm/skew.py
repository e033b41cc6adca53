"""Joins in which a few keys hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.sieve import SIEVE_WORDS, sifted  # noqa: F401

#: A key is hot if it holds more than this part of all rows; so at most as many keys are hot.
HOT_PARTS = 1024
#: Rows that a hot key has at least.
HOT_ROWS = 1000
SALTS = 64


def salted_join(
    rows: DataFrame, table: DataFrame, keys: list[str], by: list[str], counts: DataFrame | None = None, total: int | None = None
) -> DataFrame:
    """Inner join of rows with a table that has one row per key.

    The first of the keys tells which are hot: those with more than a 1024th of
    all rows (and 1000), of which there are fewer than 1024.  Hot rows are dealt over salts
    by a hash of the columns `by`, and the table's rows for hot keys are repeated for each
    salt.  counts: (first key, n), and
    total, of rows, if they are known.  Null keys meet nothing.
    """
    key = keys[0]
    hot, total = [], rows.count() if total is None else total
    if total > HOT_ROWS:
        if counts is None:
            counts = rows.groupBy(key).agg(F.count("*").alias("n"))
        hot = counts.where((F.col("n") > max(HOT_ROWS, total // HOT_PARTS)) & F.col(key).isNotNull()).select(key).collect()
    if not hot:
        return rows.join(table, keys)
    is_hot = F.col(key).isin([r[0] for r in hot])
    spread = F.when(is_hot, F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.withColumn("_salt", F.coalesce(spread, F.lit(0)))
    right = table.withColumn("_salt", F.explode(copies))
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def unused(name: str, columns: list[str]) -> str:
    """A column name like `name` that none of the columns has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name

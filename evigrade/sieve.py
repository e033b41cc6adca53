"""Joins that keep few rows of a wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits of a sieve, all that is broadcast of it.
SIEVE_WORDS = 1 << 18


def marked(rows: DataFrame, name: str, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """rows with a flag that is true for all rows whose key is wanted, and for few others.

    The sieve is a bitmap of the hashes of the wanted keys, of bounded size: with ever more of them it marks
    more of the others, and all of the wanted rows for certain.
    """
    word = lambda k: F.pmod(F.xxhash64(k, F.lit(3)), F.lit(SIEVE_WORDS)).cast("int")
    bit = lambda k: F.pmod(F.xxhash64(k, F.lit(4)), F.lit(64)).cast("int")
    sieve = wanted.select(word(wanted_key).alias("_word"), bit(wanted_key).alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit)) as _bits"))
    met = rows.withColumns({"_word": word(key), "_bit": bit(key)}).join(F.broadcast(sieve), "_word", "left")
    return met.withColumn(name, F.expr("coalesce(shiftrightunsigned(_bits, _bit) & 1, 0) = 1")).drop("_word", "_bit", "_bits")


def sifted(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, rest: bool = False) -> DataFrame:
    """All rows whose key is wanted, and few others, so that a join that follows shuffles no more; it must still be made.

    rest: the rows that do not come so, none of which has a wanted key.  Keys are without null.
    """
    met = marked(rows, "_sifted", key, wanted, wanted_key)
    return met.where(~F.col("_sifted") if rest else F.col("_sifted")).drop("_sifted")

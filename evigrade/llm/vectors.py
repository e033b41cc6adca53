"""Embedding columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column in double precision, short ones padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def is_sound(name: str = "embedding"):
    """Whether a vector has numbers only and is not zero; false for null and empty ones."""
    e = F.col(name)
    number = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(number & F.exists(e, lambda v: v != 0), F.lit(False))


def typed(df: DataFrame, name: str = "embedding") -> DataFrame:
    """float and double hold what they are given; other numbers become double."""
    kind = dict(df.dtypes)[name]
    return df if kind in ("array<float>", "array<double>") else df.withColumn(name, F.col(name).cast("array<double>"))


def sound(df: DataFrame, name: str = "embedding") -> DataFrame:
    return typed(df, name).where(is_sound(name))

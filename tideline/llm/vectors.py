"""Vectors of an Arrow batch as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def clean(df: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """(key, vector as doubles, dim, others) of the rows that have a key and a usable vector."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"), *others)
    return rows.where(F.col("key").isNotNull() & usable("vector")).withColumn("dim", F.size("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def by_width(column: pa.Array) -> list[np.ndarray]:
    """Row numbers of the lists of each length."""
    width = np.asarray(column.value_lengths())
    return [np.flatnonzero(width == w) for w in np.unique(width)]

"""Preparation: splits, boolean preferences, categorical slots, scoped persist."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: 32-bit golden-ratio multiplier of multiplicative hashing.
HASH_MULTIPLIER = 2654435761
HASH_BUCKETS = 1000
# Keys are reduced first so that the product stays within 64 bits.
KEY_RANGE = 2147483648


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split; the seed is required, and rows depend on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def hash_bucket(key: Column, salt: int = 0) -> Column:
    """Bucket 0..999 of an integer key."""
    reduced = F.pmod(key.cast("bigint") + salt, F.lit(KEY_RANGE))
    return F.pmod(F.shiftright(reduced * F.lit(HASH_MULTIPLIER), 16), F.lit(HASH_BUCKETS))


def split_hash(df: DataFrame, key: str, weights: Sequence[float], salt: int = 0) -> list[DataFrame]:
    """Split by a hash of ``key``: stable under repartitioning and repeatable in SQL.

    Keys fall into ``HASH_BUCKETS`` buckets, so shares are met to 1/1000: a smaller share is rounded,
    and one below half of that gets no rows.
    """
    total = float(sum(weights))
    bucket = hash_bucket(F.col(key), salt)
    parts, low, running = [], 0, 0.0
    for weight in weights:
        running += weight
        high = round(HASH_BUCKETS * running / total)
        parts.append(df.where((bucket >= low) & (bucket < high)))
        low = high
    return parts


def one_per_pair(ratings: DataFrame) -> DataFrame:
    """(user_id, item_id, pref): each user and item together once, with the mean of their preferences."""
    return ratings.groupBy("user_id", "item_id").agg(F.avg(F.col("pref").cast("double")).alias("pref"))


def to_boolean(ratings: DataFrame) -> DataFrame:
    """Each (user, item) once, with preference 1."""
    return ratings.select("user_id", "item_id").distinct().withColumn("pref", F.lit(1.0))


def with_categoricals(df: DataFrame, arities: Mapping[int, int], width: int,
                      features: str = "features") -> DataFrame:
    """Declare vector slots as categorical (slot -> number of values) for training."""
    attrs: dict = {"nominal": [{"idx": i, "num_vals": n} for i, n in sorted(arities.items())]}
    numeric = [{"idx": i} for i in range(width) if i not in arities]
    if numeric:
        attrs["numeric"] = numeric
    return df.withMetadata(features, {"ml_attr": {"attrs": attrs, "num_attrs": width}})


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the body of a ``with`` block, and release it after."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()

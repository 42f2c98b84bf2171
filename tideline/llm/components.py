"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tideline.session import materialise

LINKS_A_FILE = 1 << 16


def _oriented(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def _pre_aggregated(links: DataFrame) -> DataFrame:
    return links.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("_")).drop("_")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has a link; the component is its smallest id.

    Alternating star steps: first each id's larger neighbours are tied to the smallest id
    near it, then its smaller ones. Both are a minimum per id (aggregated before the
    shuffle) and a join, so an id with very many links is no burden on one task. Each round
    is written, in files of about ``LINKS_A_FILE`` links, which also cuts the lineage; the number of
    rounds grows with the logarithm of the longest path. The links are read twice, so they should
    be a written table.
    """
    same = F.struct(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)))

    def written(df: DataFrame, purpose: str, rows: int) -> DataFrame:
        return materialise(df, purpose, math.ceil(rows / LINKS_A_FILE))

    now = written(_pre_aggregated(links.where(F.col(a) != F.col(b)).select(*_oriented(a, b))), "links", links.count())
    before = now.select(same.alias("s")).first()["s"]
    while True:
        both = now.union(now.select("lo", "hi")).toDF("v", "u")
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        large = written(_pre_aggregated(large), "large-star", before[0])  # a step adds no links
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        now = written(_pre_aggregated(small), "small-star", before[0])
        before, last = now.select(same.alias("s")).first()["s"], before
        if before == last:
            break
    roots = now.select(F.col("lo").alias("id"), F.col("lo").alias("component"))
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
        roots.groupBy("id", "component").agg(F.count(F.lit(1))).select("id", "component"))


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component of each of n nodes: its smallest node."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new

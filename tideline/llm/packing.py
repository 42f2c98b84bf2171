"""Conflict-constrained best-fit packing (operator 10).

Documents are dealt by a hash of their key into groups of about ``GROUP_ROWS``, whatever their
source or cluster, and a task packs one group at a time, largest first. Open bins are kept in
the order of their residual; each carries a bitmap of its sources and one of its duplicate
clusters. The search starts at the smallest residual that takes the document and goes on to
the next larger until a bin has neither its source nor its cluster: that is the tightest
compatible bin. If there is none a new bin is opened; the number of bins has no limit.

A text larger than a bin is cut into pieces of the capacity, which fill bins of their own;
the rest of it is packed as the others are. Null and empty texts have size 0 and are packed
too. A null source or cluster conflicts with nothing. Repeated rows are packed one by one; where
more than ``MANY_ROWS`` repeat a key and cluster they are dealt to all groups. Of equal residuals
the bin opened first is tried first, and of equal sizes the smaller key is packed first. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tideline.session import materialise

GROUP_ROWS = 4096
MANY_ROWS = 64
SCHEMA = "key long, piece int, pieces int, size long, bin_id long, slot int, offset long"


def pack_group(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each item, in the given order; numbers below 0 conflict with nothing."""
    bins: list[tuple[int, int]] = []  # (residual, bin), smallest first
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    chosen = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(bins, (size, -1))
        while at < len(bins) and (source_bits[bins[at][1]] & s or cluster_bits[bins[at][1]] & c):
            at += 1
        if at < len(bins):
            residual, number = bins.pop(at)
        else:
            residual, number = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[number] |= s
        cluster_bits[number] |= c
        insort(bins, (residual - size, number))
        chosen.append(number)
    return chosen, len(source_bits)


def _numbers(values: pd.Series) -> list[int]:
    """0, 1, ... for the distinct values, -1 for null."""
    return pd.factorize(values)[0].tolist()


def copies(text: str) -> Column:
    """Clusters of equal texts, told apart by a hash; null and empty texts are in none."""
    return F.when(F.octet_length(text) > 0, F.xxhash64(text))


def pack(docs: DataFrame, capacity: int, size: Column, cluster: Column, key: str = "doc_id",
         source: str = "source") -> DataFrame:
    """(key, piece, pieces, size, bin_id, slot, offset): where each piece of each row lies.

    ``slot`` and ``offset`` are the place and the first unit within the bin.
    """
    # Written with the row numbers, so that a row stays in its group.
    items = materialise(docs.select(
        F.col(key).cast("long").alias("key"), F.col(source).alias("source"), cluster.alias("cluster"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.xxhash64(F.col(key), cluster).alias("deal"),
        F.monotonically_increasing_id().alias("row")), "packing-items")
    groups = max(1, -(-items.count() // GROUP_ROWS))
    many = items.groupBy("deal").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > MANY_ROWS)
    deal = F.when(F.col("rows").isNull(), F.col("deal")).otherwise(F.xxhash64("deal", "row"))
    items = items.join(many, "deal", "left").select(
        "key", "source", "cluster", "size", F.pmod(deal, F.lit(groups)).cast("long").alias("group"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["group"].iloc[0])
        rows = rows.sort_values(["size", "key", "source", "cluster"], ascending=[False, True, True, True],
                                kind="stable").reset_index(drop=True)
        total = rows["size"].to_numpy()
        full = total // capacity
        rest = total - full * capacity
        pieces = np.maximum(full + (rest > 0), 1)
        packed = np.flatnonzero((rest > 0) | (full == 0))
        packed = packed[np.argsort(-rest[packed], kind="stable")]
        sources, clusters = _numbers(rows["source"]), _numbers(rows["cluster"])
        chosen, used = pack_group(rest[packed].tolist(), [sources[i] for i in packed],
                                  [clusters[i] for i in packed], capacity)
        # Full pieces, each a bin.
        row = np.repeat(np.arange(len(rows)), full)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
        frame = pd.DataFrame({
            "row": np.concatenate([packed, row]), "piece": np.concatenate([full[packed], piece]),
            "size": np.concatenate([rest[packed], np.full(len(row), capacity)]),
            "bin": np.concatenate([np.array(chosen, dtype=np.int64), used + np.arange(len(row))])})
        in_bin = frame.groupby("bin")["size"]
        keys = rows["key"].astype("Int64")
        return pd.DataFrame({
            "key": keys.iloc[frame["row"]].array, "piece": frame["piece"], "pieces": pieces[frame["row"]],
            "size": frame["size"], "bin_id": (number << 32) + frame["bin"],
            "slot": in_bin.cumcount(), "offset": in_bin.cumsum() - frame["size"]})

    packed = items.groupBy("group").applyInPandas(run, SCHEMA)
    return packed.withColumnRenamed("key", key)

"""Approximate nearest neighbours over balanced posting lists (operator 7).

Centroids come from a sample (the ``SAMPLE`` vectors with the smallest hash of their key) that
is halved again and again between two means, so all lists get equal shares. A vector goes to
its nearest centroid and, as a boundary vector, to up to ``COPIES`` of those at most
``BOUNDARY`` times as far. A query searches the lists whose centroids are at most ``REACH``
times as far as its nearest; there is no limit to their number. Centroids are searched by a
beam over a graph of their nearest neighbours, which every task holds (``LISTS`` vectors).

Every vector is indexed. A list is split by a hash into chunks of about ``CHUNK`` vectors and
its queries into chunks of ``QUERY_CHUNK``; a task compares one chunk of each exactly, in
double precision, and passes on the nearest ``k`` of each query.

Null, zero or non-finite vectors and rows without a key take no part. Vectors are compared
with those of their own length; those of another length than the most frequent have one list.
Ties go to the smaller key; rows that repeat a key count once, at their smallest distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.llm.vectors import by_width, clean, matrix
from tideline.session import materialise

SAMPLE = 20_000
LISTS = 128
COPIES = 4
BOUNDARY = 1.1
REACH = 1.13
DEGREE = 16
BEAM = 32
CHUNK = 4096
QUERY_CHUNK = 256


def balanced_centroids(x: np.ndarray, lists: int, least: int = 64) -> np.ndarray:
    """Centroids of parts of equal size: each part is halved between two means until there are ``lists``, or
    halves would have fewer than ``least`` rows."""
    parts = [np.arange(len(x))]
    while 2 * len(parts) <= lists and min(len(p) for p in parts) >= 2 * least:
        halves = []
        for part in parts:
            y = x[part]
            a = y[0]
            b = y[((y - a) ** 2).sum(axis=1).argmax()]
            for _ in range(6):
                side = ((y - a) ** 2).sum(axis=1) - ((y - b) ** 2).sum(axis=1)
                order = np.argsort(side, kind="stable")
                half = len(order) // 2
                a, b = y[order[:half]].mean(axis=0), y[order[half:]].mean(axis=0)
            halves += [part[order[:half]], part[order[half:]]]
        parts = halves
    return np.stack([x[p].mean(axis=0) for p in parts])


class CentroidGraph:
    """Centroids, each joined to its nearest; searched from a few entry points by a beam."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.centroids = centroids
        n = len(centroids)
        distance = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
        near = np.argsort(distance, axis=1, kind="stable")[:, 1:degree + 1] if n > 1 else np.zeros((1, 0), np.int64)
        back: list[set[int]] = [set(row.tolist()) for row in near]
        for i, row in enumerate(near.tolist()):  # links go both ways
            for j in row:
                back[j].add(i)
        width = max(map(len, back), default=0)
        self.links = np.array([sorted(b) + [i] * (width - len(b)) for i, b in enumerate(back)], dtype=np.int64).reshape(n, width)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))

    def search(self, x: np.ndarray, ratio: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(distances, nearest first; centroids in that order) of those reached, others infinitely far.

        A row goes on until its next centroid is outside both the beam and the ratio.
        """
        rows, n = len(x), len(self.centroids)
        distance = np.full((rows, n), np.inf)
        done = np.zeros((rows, n), bool)
        distance[:, self.entries] = np.sqrt(((x[:, None] - self.centroids[self.entries][None]) ** 2).sum(axis=2))
        active = np.arange(rows)
        while len(active):
            open_ = np.where(done[active], np.inf, distance[active])
            at = open_.argmin(axis=1)
            best = open_[np.arange(len(active)), at]
            d = distance[active]
            edge = np.partition(d, min(beam, n) - 1, axis=1)[:, min(beam, n) - 1]
            going = np.isfinite(best) & (best <= np.maximum(edge, ratio * d.min(axis=1)))
            active, at = active[going], at[going]
            if not len(active):
                break
            done[active, at] = True
            links = self.links[at]
            away = np.sqrt(((x[active][:, None] - self.centroids[links]) ** 2).sum(axis=2))
            distance[active[:, None], links] = away
        order = np.argsort(distance, axis=1, kind="stable")
        return np.take_along_axis(distance, order, axis=1), order


def _listed(rows: DataFrame, graph: CentroidGraph | None, dim: int, ratio: float, copies: int | None) -> DataFrame:
    """(key, vector, list): rows with the lists they go to; a list of another length is -length."""
    schema = "key long, vector array<double>, list int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                for members in by_width(batch.column(1)):
                    part = batch.take(pa.array(members))
                    x = matrix(part.column(1))
                    if graph is None or x.shape[1] != dim:
                        row, lists = np.arange(len(x)), np.full(len(x), -x.shape[1])
                    else:
                        distance, order = graph.search(x, ratio)
                        take = distance <= ratio * distance[:, :1]
                        if copies is not None:
                            take[:, copies:] = False
                        row, place = np.nonzero(take)
                        lists = order[row, place]
                    out = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [out.column(0), out.column(1), pa.array(lists, pa.int32())], ["key", "vector", "list"])

    return rows.select("key", "vector").mapInArrow(run, schema)


def _nearest(queries: np.ndarray, query_keys: np.ndarray, x: np.ndarray, keys: np.ndarray, k: int) -> pd.DataFrame:
    out = []
    for q, name in zip(queries, query_keys, strict=True):
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        d[keys == name] = np.inf
        near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
        near = near[np.isfinite(d[near])]
        near = near[np.lexsort((keys[near], d[near]))][:k]
        out.append(pd.DataFrame({"query_id": name, "vec_id": keys[near], "score": d[near]}))
    return pd.concat(out)


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           lists: int = LISTS, reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``k`` found for each row where ``is_query``."""
    rows = clean(vectors, key, vector)
    sample = rows.select("vector", "dim", F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(SAMPLE).collect()
    widths = pd.Series([r["dim"] for r in sample], dtype="int64").mode()
    dim = int(widths.iloc[0]) if len(widths) else 0
    points = [r["vector"] for r in sample if r["dim"] == dim]
    graph = CentroidGraph(balanced_centroids(np.array(points), lists)) if points else None

    posted = materialise(_listed(rows, graph, dim, BOUNDARY, COPIES), "lists")
    chosen = rows.join(vectors.where(is_query).select(F.col(key).cast("long").alias("key")).distinct(), "key", "left_semi")
    asked = materialise(_listed(chosen, graph, dim, reach, None), "probes")
    # Long lists, and lists with many queries, are split; the counts have a row for each list.
    n_rows = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    n_asked = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_CHUNK).cast("int").alias("parts"))
    split = materialise(n_rows.join(n_asked, "list"), "split")
    part = lambda of: F.pmod(F.xxhash64("key"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = posted.join(split, "list").select(
        "key", "vector", "list", part("chunks").alias("chunk"), every("parts").alias("part"))
    right = asked.join(split.toDF("l", "rows_in", "asked_in"), F.col("list") == F.col("l")).select(
        "key", "vector", F.col("list").alias("q_list"), part("asked_in").alias("q_part"),
        every("rows_in").alias("q_chunk"))

    def compare(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _nearest(np.stack(q["vector"].to_numpy()), q["key"].to_numpy(), np.stack(x["vector"].to_numpy()),
                        x["key"].to_numpy(), k)

    found = left.groupBy("list", "chunk", "part").cogroup(right.groupBy("q_list", "q_chunk", "q_part")).applyInPandas(
        compare, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

"""Embedding near-dedup by cross-polytope hashing (operator 2).

Vectors of one label link when their cosine, in double precision, is at least ``LEAST``. A
hash rotates the unit vector three times (random signs, then a fast Hadamard transform) and
takes the axis nearest to it; ``HASHES`` of these make a bucket of each of ``TABLES`` tables.
Besides its own bucket, a vector also probes the one where its least certain hash takes the
second nearest axis. Every pair that meets in a bucket, once as its own, is verified.

Equal vectors of a label are one class, found by grouping; hashing and verification run on
one vector of each class. A bucket is compared in blocks of about ``BLOCK`` vectors dealt by
hash, so neither a bucket nor its pairs ever gather in one task: a block pair gives for each
vector the number of its links and its component within the block. A pair is counted in
the first bucket of those it meets in, hence once.

Null labels, and null, zero or non-finite vectors link with nothing; vectors of different
length don't link. Rows without a key are given back unlinked. Vectors at the threshold meet in
some bucket with a chance of more than 0.999; nothing below it is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.components import components, labels
from tideline.llm.flat import mix
from tideline.llm.vectors import by_width, clean, matrix
from tideline.session import materialise

LEAST = 0.98
TABLES = 10
HASHES = 3
BLOCK = 512
SMALL_GROUP = 2048  # rows of small buckets compared by one call
SEED = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(rows, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, width)
        h *= 2
    return x / np.sqrt(width)


def bucket_ids(unit: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Per row the own bucket of each table, then the probed bucket of each table."""
    rows, dim = unit.shape
    width = 1 << max(int(dim - 1).bit_length(), 1)
    padded = np.zeros((rows, width))
    padded[:, :dim] = unit
    each = np.arange(rows)
    own, probe = [], []
    for table in range(TABLES):
        signs = np.random.default_rng((SEED, table, width)).choice([-1.0, 1.0], (HASHES, 3, width))
        near, second, gap = [], [], []
        for k in range(HASHES):
            y = padded
            for turn in range(3):
                y = hadamard(y * signs[k, turn])
            size = np.abs(y)
            a = size.argmax(axis=1)
            top = size[each, a]
            size[each, a] = -1
            b = size.argmax(axis=1)
            near.append(2 * a + (y[each, a] > 0))
            second.append(2 * b + (y[each, b] > 0))
            gap.append(top - size[each, b])
        near, second, unsure = np.stack(near, 1), np.stack(second, 1), np.stack(gap, 1).argmin(axis=1)
        other = near.copy()
        other[each, unsure] = second[each, unsure]
        for axes, out in ((near, own), (other, probe)):
            code = mix(label.astype(np.int64).view(np.uint64) ^ np.uint64(table << 40 | dim))
            for k in range(HASHES):
                code = mix(code ^ axes[:, k].astype(np.uint64))
            out.append(code.view(np.int64))
    return np.stack(own + probe, axis=1)


def _hashed(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_width(batch.column(2)):
                part = batch.take(pa.array(rows))
                x = matrix(part.column(2))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                ids = bucket_ids(unit, np.asarray(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(ids), pa.list_(pa.int64()))],
                    ["key", "label", "vector", "rows", "buckets"])

    return classes.select("key", "label", "vector", "rows").mapInArrow(
        run, "key long, label long, vector array<double>, rows long, buckets array<long>")


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of bucket ids of two vectors: the first bucket both are in, once as its own; 0 if none."""
    tables = a.shape[1] // 2
    where = np.zeros(len(a), np.int64)
    for t in range(tables):
        own_a, own_b, probe_a, probe_b = a[:, t], b[:, t], a[:, tables + t], b[:, tables + t]
        low = np.minimum(own_a, own_b)
        met = [(own_a == own_b, own_a), ((own_a == probe_b) & (own_b == probe_a), low), (own_a == probe_b, own_a),
               (own_b == probe_a, own_b)]
        for yes, bucket in met:
            where = np.where((where == 0) & yes, bucket, where)
    return where


def _compare(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(x @ y.T >= least)


def _in_groups(entries: DataFrame, least: float) -> DataFrame:
    """(key, links, root) from rows grouped by (deal, low, high): blocks of whole buckets."""
    schema = "key long, links long, root long"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bucket", "key"], kind="stable")
        bucket, key = frame["bucket"].to_numpy(), frame["key"].to_numpy()
        rows, chunk = frame["rows"].to_numpy(), frame["chunk"].to_numpy()
        low, high = int(frame["low"].iloc[0]), int(frame["high"].iloc[0])
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        vectors, buckets, out = frame["vector"].to_numpy(), frame["buckets"].to_numpy(), []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if end - begin < 2:
                continue
            x = np.stack(vectors[begin:end]).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            own, k, c = np.stack(buckets[begin:end]), key[begin:end], chunk[begin:end]
            first, last = np.flatnonzero(c == low), np.flatnonzero(c == high)
            i, j = _compare(x[first], x[last], least)
            i, j = first[i], last[j]
            if low == high:
                i, j = i[k[i] < k[j]], j[k[i] < k[j]]
            once = _first_meeting(own[i], own[j]) == bucket[begin]
            i, j = i[once], j[once]
            if len(i):
                n = end - begin
                weight = rows[begin:end]
                links = np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)
                root = labels(n, i, j)
                some = np.flatnonzero(links)
                out.append(pd.DataFrame({"key": k[some], "links": links[some].astype(np.int64), "root": k[root[some]]}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "links": [], "root": []}, dtype=np.int64)

    return entries.groupBy("deal", "low", "high").applyInPandas(run, schema)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    least: float = LEAST) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    good = clean(vectors, key, vector, F.col(label).cast("long").alias("label")).where("label is not null")
    classes = materialise(good.groupBy("label", "dim", "vector").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("rows")), "classes")
    hashed = materialise(_hashed(classes), "hashed")

    entries = materialise(hashed.select("key", F.explode(F.array_distinct("buckets")).alias("bucket")), "entries")
    full = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    total = max(entries.count(), 1)
    small = max(1, -(-total // SMALL_GROUP))
    shared = entries.join(full, "bucket").withColumn("chunks", F.ceil(F.col("n") / BLOCK).cast("int"))
    shared = shared.withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    # A chunk meets itself and every other chunk of its bucket.
    meets = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = shared.withColumn("other", meets).select(
        "key", "bucket", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        # Small buckets share a group; a bucket of several blocks has groups of its own.
        F.when(F.col("chunks") == 1, F.pmod("bucket", F.lit(small))).otherwise(F.col("bucket")).alias("deal"))
    found = materialise(_in_groups(dealt.join(hashed, "key"), least), "links")

    ties = components(found.where("key <> root"), "key", "root").toDF("id", "component")
    counts = found.groupBy("key").agg(F.sum("links").alias("links")).toDF("id_c", "links")
    of_class = (classes.join(ties, F.col("key") == F.col("id"), "left")
                .join(counts, F.col("key") == F.col("id_c"), "left")
                .select(F.col("label").alias("l"), F.col("vector").alias("v"), F.col("key").alias("first"),
                        (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                        F.coalesce("component", "key").alias("component")))
    tied = good.join(of_class, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))).select(
        F.col("key").alias("k"), "links", "component").groupBy("k").agg(
        F.max("links").alias("links"), F.min("component").alias("component"))
    every = vectors.select(F.col(key).alias("id"))
    component = F.coalesce("component", F.col("id").cast("long"))
    return every.join(tied, F.col("id").cast("long") == F.col("k"), "left").select(
        F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))

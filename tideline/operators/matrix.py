"""Distributed row matrix: covariance and principal components.

The matrix of products of all columns is never held in one place: tasks add up tiles of
``COLUMN_BLOCK`` x ``COLUMN_BLOCK`` cells, pass on their rows, and what Spark adds up stays a
table of row pieces. Principal components multiply that table by a few vectors at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tideline.session import materialise

COLUMN_BLOCK = 256
TASK_BYTES = 256 << 20  # of tiles that a task holds; with more, rows are read once per group of tiles
SPREAD = 16             # partial sums of one row piece are added up in so many parts first
WHOLE = 256             # up to this width, one multiplication yields all components
TOLERANCE = 1e-11       # of a component's residual, in shares of the largest variance
MOST_BASES = 12         # multiplications before the basis is begun anew from the best vectors

PIECES = "i INT, block INT, cells ARRAY<DOUBLE>"


def _moments(df: DataFrame, features: str) -> tuple[int, np.ndarray]:
    """(rows, mean of each column): one partial-then-final aggregate."""
    summary = Summarizer.metrics("count", "mean").summary(F.col(features))
    row = df.select(summary.alias("s")).select("s.count", "s.mean").first()
    if not row["count"]:
        raise ValueError("an empty matrix has no covariance")
    return row["count"], row["mean"].toArray()


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def _tiles(width: int) -> list[tuple[int, int]]:
    blocks = -(-width // COLUMN_BLOCK)
    return [(i, j) for i in range(blocks) for j in range(i, blocks)]


def _tile_groups(width: int) -> int:
    """Into how many groups the tiles are cut, so that a task can hold those of one."""
    return max(1, math.ceil(len(_tiles(width)) * COLUMN_BLOCK ** 2 * 8 / TASK_BYTES))


def _partial_products(df: DataFrame, features: str, mean: np.ndarray) -> DataFrame:
    """(i, block, cells, part): a task's sums of products of centred columns, in pieces of a row."""
    width, groups = len(mean), _tile_groups(len(mean))
    rows = df.select(vector_to_array(F.col(features)).alias("row"))
    if groups > 1:
        rows = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(
            "group", F.pmod(F.xxhash64("row"), F.lit(SPREAD * SPREAD)))
    else:
        rows = rows.withColumn("group", F.lit(0))
    rows = rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    of_group = [[t for n, t in enumerate(_tiles(width)) if n % groups == g] for g in range(groups)]

    def pieces(group: int, part: int, sums: dict) -> Iterator[pa.RecordBatch]:
        for (i, j), tile in sums.items():
            n = len(tile)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(i * COLUMN_BLOCK, i * COLUMN_BLOCK + n), pa.int32()),
                pa.array(np.full(n, j), pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * tile.shape[1], pa.int32()), pa.array(tile.ravel())),
                pa.array(np.full(n, part), pa.int32())], names=["i", "block", "cells", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, sums = None, 0, {}
        for batch in batches:
            group = np.asarray(batch.column(1))
            for g in np.unique(group).tolist():
                if g != now:  # rows of a task are few groups, one after another or not: none is held twice
                    yield from pieces(now, part, sums)
                    now, sums = g, {}
                part = batch.column(2)[0].as_py()
                values = _lists(batch.column(0).filter(pa.array(group == g)), width) - mean
                for i, j in of_group[g]:
                    left, right = (values[:, b * COLUMN_BLOCK:(b + 1) * COLUMN_BLOCK] for b in (i, j))
                    product = left.T @ right
                    sums[i, j] = sums[i, j] + product if (i, j) in sums else product
        yield from pieces(now, part, sums)

    if groups > 1:
        rows = rows.sortWithinPartitions("group")
    return rows.mapInArrow(run, PIECES + ", part INT")


def _added(pieces: DataFrame, *keys: str) -> DataFrame:
    """Pieces of equal keys added up, one sum at a time in a sorted partition."""
    names = [*keys, "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            marks = np.stack([np.asarray(batch.column(i)) for i in range(len(keys))], axis=1)
            offsets = np.asarray(batch.column(len(keys)).offsets)
            cells = np.asarray(batch.column(len(keys)).values)
            first = np.flatnonzero(np.r_[True, (np.diff(marks, axis=0) != 0).any(axis=1)])
            done_keys, done = [], []
            for a, b in zip(first, [*first[1:], len(marks)], strict=True):
                part = cells[offsets[a]:offsets[b]].reshape(b - a, -1).sum(axis=0)
                key = tuple(marks[a].tolist())
                if key == now:
                    total = total + part
                    continue
                if now is not None:
                    done_keys.append(now)
                    done.append(total)
                now, total = key, part
            if done:
                yield _summed(done_keys, done)
        if now is not None:
            yield _summed([now], [total])

    def _summed(done_keys: list[tuple], done: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in done_keys], pa.int32()) for i in range(len(keys))]
        ends = np.cumsum([0, *map(len, done)])
        cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(done)))
        return pa.RecordBatch.from_arrays([*columns, cells], names)

    schema = ", ".join(f"{k} INT" for k in keys) + ", cells ARRAY<DOUBLE>"
    return pieces.select(*names).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def covariance_pieces(df: DataFrame, features: str = "features") -> tuple[DataFrame, int]:
    """((i, block, cells), width): row ``i`` of the covariance, cut into column blocks from its own on."""
    n, mean = _moments(df, features)
    if n < 2:
        raise ValueError("a covariance needs two rows")
    partial = _added(_partial_products(df, features, mean), "i", "block", "part")
    total = _added(partial, "i", "block")
    return total.select("i", "block", F.transform("cells", lambda c: c / (n - 1)).alias("cells")), len(mean)


def covariance(df: DataFrame, features: str = "features") -> DataFrame:
    """Sample covariance as rows (i, j, cov) with i <= j, spread over the executors."""
    pieces, _ = covariance_pieces(df, features)
    cells = pieces.select("i", "block", F.posexplode("cells").alias("place", "cov"))
    j = (F.col("block") * COLUMN_BLOCK + F.col("place")).cast("int")
    return cells.select("i", j.alias("j"), "cov").where("i <= j")


def _times(pieces: DataFrame, vectors: np.ndarray) -> np.ndarray:
    """The covariance times a few vectors: each task multiplies its pieces, rows of sums come back."""
    count = vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros_like(vectors)
        for batch in batches:
            i, block = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            offsets, cells = np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).values)
            for b in np.unique(block).tolist():
                rows = np.flatnonzero(block == b)
                low = b * COLUMN_BLOCK
                piece = np.stack([cells[offsets[r]:offsets[r + 1]] for r in rows])
                high, at = low + piece.shape[1], i[rows]
                # A piece of its own block holds both triangles; the others stand for their mirror images too.
                np.add.at(product, at, piece @ vectors[low:high])
                beyond = at < low
                product[low:high] += piece[beyond].T @ vectors[at[beyond]]
        some = np.flatnonzero(product.any(axis=1))
        yield pa.RecordBatch.from_arrays([
            pa.array(some, pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * count, pa.int32()), pa.array(product[some].ravel()))],
            ["i", "cells"])

    parts = pieces.mapInArrow(run, "i INT, cells ARRAY<DOUBLE>")
    total = np.zeros_like(vectors)
    for row in _added(parts, "i").toLocalIterator():
        total[row["i"]] = row["cells"]
    return total


def _orthonormal(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What ``vectors`` add to the span of ``basis``."""
    for _ in range(2):
        vectors = vectors - basis @ (basis.T @ vectors)
    q, r = np.linalg.qr(vectors)
    size = np.abs(np.diag(r))
    q = q[:, size > 1e-12 * max(size.max(initial=0.0), 1e-300)]
    return np.linalg.qr(q - basis @ (basis.T @ q))[0]


def _leading(pieces: DataFrame, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, components as columns) of the ``k`` largest, by a block Krylov basis."""
    start = width if width <= WHOLE else min(width, max(2 * k, k + 16))
    basis = np.linalg.qr(np.random.default_rng(17).standard_normal((width, start)))[0] if start < width else np.eye(width)
    product, fresh, bases = np.zeros((width, 0)), basis, 0
    while True:
        product, bases = np.hstack([product, _times(pieces, fresh)]), bases + 1
        small = basis.T @ product
        variances, turns = np.linalg.eigh((small + small.T) / 2)
        variances, turns = variances[::-1], turns[:, ::-1]
        vectors = basis @ turns[:, :k]
        residual = np.linalg.norm(product @ turns[:, :k] - vectors * variances[:k], axis=0)
        if basis.shape[1] >= width or residual.max() <= TOLERANCE * max(variances[0], 1e-300):
            return variances[:k], vectors
        if bases == MOST_BASES:
            basis, product, bases = basis @ turns[:, :start], product @ turns[:, :start], 1
            fresh = _orthonormal(product, basis)
        else:
            fresh = _orthonormal(product[:, -fresh.shape[1]:], basis)
        if not fresh.shape[1]:
            return variances[:k], vectors
        basis = np.hstack([basis, fresh])


def pca(df: DataFrame, k: int, features: str = "features") -> DataFrame:
    """Top-k principal components as rows (component, feature, loading, explained).

    A component's sign is arbitrary; the largest loading is made positive. The driver holds a basis
    of a few vectors per component, never the covariance of a wide matrix.
    """
    first = df.select(features).first()
    if first is None or k > first[0].size:
        raise ValueError("k must not exceed the number of columns of a non-empty matrix")
    pieces, width = covariance_pieces(df, features)
    pieces = materialise(pieces, "covariance")
    own = F.element_at("cells", (F.col("i") - F.col("block") * COLUMN_BLOCK + 1).cast("int"))
    total = pieces.where(F.expr(f"i div {COLUMN_BLOCK} = block")).agg(F.sum(own)).first()[0]
    variances, loadings = _leading(pieces, width, k)
    peaks = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
    loadings = loadings * np.where(peaks < 0, -1.0, 1.0)
    explained = variances / total
    rows = [
        (c, f, float(loadings[f, c]), float(explained[c]))
        for c in range(k) for f in range(width)
    ]
    return df.sparkSession.createDataFrame(
        rows, "component INT, feature INT, loading DOUBLE, explained DOUBLE"
    )

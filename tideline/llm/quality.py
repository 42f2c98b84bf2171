"""Quality classifier: a generalised additive model with pairwise interactions (operator 6).

A text is described by about twenty figures on its bytes and words. Each figure is cut into
bins; cyclic boosting gives every figure in turn a shallow tree over its bins, fitted to what
is still unexplained, and adds its leaves to that figure's lookup table. Afterwards the pairs
of figures that explain most of the rest get tables of their own in the same way. A score is
the logistic of the sum of looked-up values: for a batch of texts a few vectorised additions.

The fit takes a documented sample, the ``SAMPLE_ROWS`` labelled rows with the smallest hash
of their key; scoring runs over all texts, whole. Null and empty texts are scored as texts
without words. Null labels are left out; of several labels of a key each counts, and rows
that repeat a key count once in the fit (the least figures) and are scored one by one. With no
label, or one class only, the score is the smoothed share of the class. An empty table gives no
rows; columns named ``score`` or ``predicted`` are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tideline.llm.flat import PART_BYTES, Words, mix, slices, string_column, words
from tideline.llm.langid import held_out

SAMPLE_ROWS = 6000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIRS = 6
PAIR_ROUNDS = 40
RATE = 0.15
LEAST_HESSIAN = 2.0
RIDGE = 1.0
THRESHOLD = 0.3

FEATURES = [
    "bytes", "words", "word_bytes", "longest", "capitals", "digits", "marks", "symbols", "bars", "cries", "stops",
    "breaks", "controls", "wide", "distinct", "repeated", "distinct_pairs", "commonest", "short", "ended",
]

_CLASS = np.zeros(256, dtype=np.uint8)
_GROUPS = {
    "capitals": range(65, 91), "digits": range(48, 58), "symbols": b"#$%&*+<=>@^~\\_{}[]/", "bars": b"|",
    "cries": b"!?", "stops": b".,;:", "breaks": b"\n", "controls": [*range(0, 9), *range(14, 32), 127],
    "wide": range(128, 256),
}
for _number, _members in enumerate(_GROUPS.values(), start=1):
    _CLASS[list(_members)] = _number
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``ends``."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[ends])


def _distinct(codes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of distinct codes, count of the commonest) of each text."""
    if not len(codes):
        return np.zeros(n_docs), np.zeros(n_docs)
    key = np.sort(mix(codes ^ mix(doc.astype(np.uint64))) >> np.uint64(24) | doc.astype(np.uint64) << np.uint64(40))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    of = (key[first] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n_docs)
    np.maximum.at(most, of, np.diff(np.concatenate([first, [len(key)]])))
    return np.bincount(of, minlength=n_docs).astype(float), most


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice."""
    base = int(offsets[0])
    flat, bounds = data[base:int(offsets[-1])], np.asarray(offsets) - base
    n_docs, size = len(bounds) - 1, np.diff(bounds)
    w: Words = words(data, offsets)
    counts, ends = w.counts(), w.firsts()
    per_byte, per_word = np.maximum(size, 1), np.maximum(counts, 1)
    kind = _CLASS[flat]
    length = w.end - w.start
    longest = np.zeros(n_docs)
    np.maximum.at(longest, w.doc, length)
    distinct, most = _distinct(w.hash, w.doc, n_docs)
    follows = w.doc[1:] == w.doc[:-1]
    pairs = (w.hash[1:] + mix(w.hash[:-1]))[follows]
    pair_doc = w.doc[1:][follows]
    distinct_pairs, _ = _distinct(pairs, pair_doc, n_docs)
    repeated = np.bincount(w.doc[1:][follows & (w.hash[1:] == w.hash[:-1])], minlength=n_docs)
    last = flat[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    figure = {
        "bytes": np.log1p(size), "words": np.log1p(counts), "word_bytes": _per_text(length, ends) / per_word,
        "longest": np.log1p(longest), "marks": _per_text(_MARK[flat], bounds) / per_byte,
        "distinct": distinct / per_word, "repeated": repeated / per_word,
        "distinct_pairs": distinct_pairs / np.maximum(counts - 1, 1), "commonest": most / per_word,
        "short": _per_text(length <= 2, ends) / per_word,
        "ended": _per_text((last == 46) | (last == 33) | (last == 63), ends) / per_word,
    }
    for number, name in enumerate(_GROUPS, start=1):
        figure[name] = _per_text(kind == number, bounds) / per_byte
    return np.stack([figure[name] for name in FEATURES], axis=1)


def _tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Values of a tree of two levels over bins in order: at most four leaves."""
    values = np.zeros(len(gradient))

    def leaf(low: int, high: int) -> float:
        return gradient[low:high].sum() / (hessian[low:high].sum() + RIDGE)

    def cut(low: int, high: int) -> int | None:
        g, h = np.cumsum(gradient[low:high]), np.cumsum(hessian[low:high])
        left_g, left_h = g[:-1], h[:-1]
        right_g, right_h = g[-1] - left_g, h[-1] - left_h
        gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE)
        gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = -1.0
        if not len(gain) or gain.max() <= g[-1] ** 2 / (h[-1] + RIDGE):
            return None
        return low + int(gain.argmax()) + 1

    spans, todo = [], [(0, len(gradient), 0)]
    while todo:
        low, high, depth = todo.pop()
        at = cut(low, high) if depth < 2 else None
        if at is None:
            spans.append((low, high))
        else:
            todo += [(low, at, depth + 1), (at, high, depth + 1)]
    for low, high in spans:
        values[low:high] = leaf(low, high)
    return values


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """(values, gain) of the best pair of cuts, one along each side of a grid: four leaves."""
    g = np.zeros((gradient.shape[0] + 1, gradient.shape[1] + 1))
    h = g.copy()
    g[1:, 1:] = gradient.cumsum(0).cumsum(1)
    h[1:, 1:] = hessian.cumsum(0).cumsum(1)

    def corners(t: np.ndarray) -> list[np.ndarray]:
        a = t[1:-1, 1:-1]
        top, left, whole = t[1:-1, -1:], t[-1:, 1:-1], t[-1, -1]
        return [a, top - a, left - a, whole - top - left + a]

    gc, hc = corners(g), corners(h)
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(gc, hc, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = [float(x[i, j] / (y[i, j] + RIDGE)) for x, y in zip(gc, hc, strict=True)]
    values = np.empty(gradient.shape)
    values[:i + 1, :j + 1], values[:i + 1, j + 1:], values[i + 1:, :j + 1], values[i + 1:, j + 1:] = leaf
    return values, float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + RIDGE))


class AdditiveModel:
    """Lookup tables of single figures and of pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        positive = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(positive / (1 - positive)))
        width = x.shape[1]
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, f], shares)) if len(x) else np.zeros(0) for f in range(width)]
        # Bins of a pair's side are runs of the bins of the figure.
        self.coarse = [(np.arange(len(c) + 1) * PAIR_BINS) // (len(c) + 1) for c in self.cuts]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if len(np.unique(y)) == 2:
            self._fit(self.bins(x), y.astype(float))

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)

    def _fit(self, b: np.ndarray, y: np.ndarray) -> None:
        total = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                if len(table) > 1:
                    p = 1 / (1 + np.exp(-total))
                    size = len(table)
                    step = RATE * _tree(np.bincount(b[:, f], y - p, size), np.bincount(b[:, f], p * (1 - p), size))
                    table += step
                    total += step[b[:, f]]
        coarse = np.stack([c[b[:, f]] for f, c in enumerate(self.coarse)], axis=1)
        cells = PAIR_BINS * PAIR_BINS

        def grid(i: int, j: int) -> tuple[np.ndarray, float]:
            p = 1 / (1 + np.exp(-total))
            at = coarse[:, i] * PAIR_BINS + coarse[:, j]
            shape = (PAIR_BINS, PAIR_BINS)
            return _pair_tree(np.bincount(at, y - p, cells).reshape(shape),
                              np.bincount(at, p * (1 - p), cells).reshape(shape))

        width = b.shape[1]
        gains = sorted(((grid(i, j)[1], i, j) for i in range(width) for j in range(i)), reverse=True)
        self.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for gain, i, j in gains[:PAIRS] if gain > 0]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                step = RATE * grid(i, j)[0]
                table += step
                total += step[coarse[:, i], coarse[:, j]]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[b[:, f]]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return 1 / (1 + np.exp(-total))


def _features_of(batch: pa.RecordBatch, text: str) -> np.ndarray:
    data, offsets = string_column(batch, text)
    parts = [features(data, offsets[i:j + 1]) for i, j in slices(offsets, PART_BYTES)]
    return np.concatenate([np.zeros((0, len(FEATURES))), *parts])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> AdditiveModel:
    """A model fitted on the driver from the figures of a sample of bounded size."""
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isNotNull() & F.col("key").isNotNull() & ~held_out(F.col("key")))
    chosen = marked.orderBy(F.xxhash64(F.col("key").cast("string")), "key", "label").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # At most SAMPLE_ROWS rows of two numbers, whatever the input.
    rows = texts.join(F.broadcast(chosen.distinct()), "key").select("key", "label", "text")
    schema = T.StructType([T.StructField("key", texts.schema["key"].dataType), T.StructField("label", T.IntegerType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features_of(batch, "text")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], schema.names)

    # Rows that repeat a key are one (the least figures): no more rows than labels come back.
    once = rows.mapInArrow(run, schema).groupBy("key", "label").agg(F.min("x").alias("x"))
    sample = once.orderBy("key", "label").toPandas()
    x = np.stack(sample["x"].tolist()) if len(sample) else np.zeros((0, len(FEATURES)))
    return AdditiveModel(x, sample["label"].to_numpy(dtype=np.int64))


def classify(docs: DataFrame, model: AdditiveModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which replace columns of these names."""
    added = {"score": T.DoubleType(), "predicted": T.IntegerType()}
    fields = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType(fields + [T.StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_column(batch, text)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
            for i, j in slices(offsets, PART_BYTES):
                score = model.score(features(data, offsets[i:j + 1]))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, j - i) for c in columns]
                    + [pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema.names)

    return docs.mapInArrow(run, schema)

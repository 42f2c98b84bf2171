"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones (operator 12).

The terms that the queries ask for, and no others, are looked up in every whole document; a
row per document (length, its asked terms, their frequencies) is written, and the corpus
figures come from that table. A task then searches its documents piece by piece. In a piece,
a term's documents are a list in order with their impacts, cut into blocks with the largest
impact of each. For a query the short lists are added up into accumulators (term at a time);
these become one more iterator with block bounds, beside the long lists. Blocks of documents
are visited in order (document at a time) and skipped where the bounds of all iterators
together cannot reach the query's k-th best score so far. A task gives the k best documents of
each query, and Spark ranks those of all tasks: exact, as the scores are whole numbers.

Terms are runs of letters and digits of ASCII and of all characters beyond; only A-Z are
lower-cased. Terms are compared by 64-bit hashes.

Defined cases: a null text has no term, and a document without one is not counted. A query
without a term found anywhere has no rows. Rows that repeat a document key are documents of
their own; rows that repeat a query key are one query with the terms of all. Equal scores rank
by ascending document key, a null key last. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tideline.llm import flat
from tideline.session import materialise

# What terms are made of, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, STEP, LENGTH_PART, LENGTH_BASE, LENGTH_WEIGHT = 1_000_000_000, 1000, 50, 50, 20

IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

TERMS_AT_ONCE = 100_000  # terms of queries searched for in one pass over the documents
BLOCK = 64               # documents per block of a list
VISIT = 16               # blocks scored together before the threshold is raised again
LONG = 8                 # a list is long if it holds more than one document in this many
LAST = np.iinfo(np.int64).max


def query_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term), each once."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(F.col(item).alias("item"), F.explode(found).alias("term")).distinct()


def _term_hashes(terms: list[str]) -> np.ndarray:
    parts = [t.encode() for t in terms]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    return flat.words(data, np.cumsum([0, *map(len, parts)]), is_word=IS_TERM).hash


def postings(docs: DataFrame, terms: list[str], key: str, text: str) -> DataFrame:
    """(key, n, terms, counts) of documents with a term: ``n`` counts all, the lists those asked for."""
    hashes = _term_hashes(terms)
    order = np.argsort(hashes)
    ordered = hashes[order]
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.string_column(batch, "text")
            for i, j in flat.slices(offsets):
                w = flat.words(data, offsets[i:j + 1], lower=True, is_word=IS_TERM)
                n = w.counts()
                place = np.minimum(np.searchsorted(ordered, w.hash), len(ordered) - 1)
                hit = ordered[place] == w.hash
                code, counts = np.unique(w.doc[hit] * len(ordered) + order[place[hit]], return_counts=True)
                doc, term = np.divmod(code, len(ordered))
                some = np.flatnonzero(n)
                ends = pa.array(np.searchsorted(doc, np.append(some, j - i)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (term, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(i + some)), pa.array(n[some], pa.int64()), *lists], schema.names)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


@dataclass
class Lists:
    """The inverted lists of a piece: documents in order and their impacts, one term after another."""

    n_docs: int
    begin: np.ndarray
    doc: np.ndarray
    impact: np.ndarray

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.begin[term], self.begin[term + 1]
        return self.doc[a:b], self.impact[a:b]


def invert(n: np.ndarray, sizes: np.ndarray, term: np.ndarray, count: np.ndarray,
           weights: np.ndarray, total: int, length: int) -> Lists:
    """Lists of a piece's documents with lengths ``n`` among ``total`` documents of ``length`` terms."""
    doc = np.repeat(np.arange(len(n)), sizes)
    m = 100 - LENGTH_BASE + (LENGTH_PART * n * total) // length
    impact = weights[term] * ((SCALE * count) // (STEP * count + LENGTH_WEIGHT * m[doc]))
    order = np.argsort(term, kind="stable")
    begin = np.searchsorted(term[order], np.arange(len(weights) + 1))
    return Lists(len(n), begin, doc[order], impact[order])


def _block_bounds(doc: np.ndarray, impact: np.ndarray, blocks: int) -> np.ndarray:
    bounds = np.zeros(blocks, np.int64)
    if len(doc):
        block = doc // BLOCK
        first = np.flatnonzero(np.diff(block, prepend=-1))
        bounds[block[first]] = np.maximum.reduceat(impact, first)
    return bounds


class Best:
    """The k best (score, key) of a query so far, with the place of each in the task's rows."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """What a document must reach to be among the best."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        enough = score >= self.threshold
        if not enough.any():
            return
        score = np.concatenate([self.score, score[enough]])
        key = np.concatenate([self.key, key[enough]])
        order = np.lexsort((key, -score))[:self.k]
        self.score, self.key = score[order], key[order]


def search_piece(lists: Lists, keys: np.ndarray, terms: np.ndarray, best: Best,
                 bounds: dict[int, np.ndarray]) -> int:
    """Add a piece's documents to the best of one query; the number of blocks skipped.

    ``bounds`` keeps the block bounds of long lists for the following queries.
    """
    blocks = -(-lists.n_docs // BLOCK)
    sizes = lists.begin[terms + 1] - lists.begin[terms]
    short, long = terms[(sizes > 0) & (sizes * LONG <= lists.n_docs)], terms[sizes * LONG > lists.n_docs]
    # Term at a time: the short lists as one list of sums.
    sums = np.zeros(lists.n_docs, np.int64)
    for term in short:
        doc, impact = lists.of(term)
        sums[doc] += impact
    held = np.flatnonzero(sums)
    iterators = [(held, sums[held])]
    bound = _block_bounds(held, sums[held], blocks)
    for term in long:
        if term not in bounds:
            bounds[term] = _block_bounds(*lists.of(term), blocks)
        bound = bound + bounds[term]
        iterators.append(lists.of(term))
    # Document at a time: blocks in order, past those that cannot reach the threshold.
    waiting, skipped = np.flatnonzero(bound >= best.threshold), blocks
    for at in range(0, len(waiting), VISIT):
        visit = waiting[at:at + VISIT]
        visit = visit[bound[visit] >= best.threshold]
        if not len(visit):
            continue
        skipped -= len(visit)
        low, high = visit[0] * BLOCK, min((visit[-1] + 1) * BLOCK, lists.n_docs)
        score = np.zeros(high - low, np.int64)
        for doc, impact in iterators:
            a, b = np.searchsorted(doc, (low, high))
            score[doc[a:b] - low] += impact[a:b]
        best.add(score, keys[low:high])
    return skipped


def _search(table: DataFrame, queries: list[np.ndarray], weights: np.ndarray, total: int, length: int,
            k: int) -> DataFrame:
    """(number of the query, key, score): the k best of every task."""
    schema = T.StructType([T.StructField("number", T.IntegerType()), table.schema["key"],
                           T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in batches:
            keys = batch.column(0)
            keys = np.asarray(keys.fill_null(LAST)) if keys.null_count else np.asarray(keys)
            sizes = np.asarray(pc.list_value_length(batch.column(2)))
            lists = invert(np.asarray(batch.column(1)), sizes, np.asarray(batch.column(2).flatten()),
                           np.asarray(batch.column(3).flatten()).astype(np.int64), weights, total, length)
            bounds: dict[int, np.ndarray] = {}
            for terms, found in zip(queries, best, strict=True):
                search_piece(lists, keys, terms, found, bounds)
        number = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        key = np.concatenate([np.zeros(0, np.int64), *[b.key for b in best]])
        score = np.concatenate([np.zeros(0, np.int64), *[b.score for b in best]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(key, pa.int64(), mask=key == LAST), pa.array(score)], schema.names)

    return table.mapInArrow(run, schema)


def _search_block(docs: DataFrame, wanted: DataFrame, key: str, text: str, k: int) -> list[DataFrame]:
    """The k best (item, key, score) of some queries, whose terms are few enough for the driver; [] without any."""
    spark = docs.sparkSession
    of_item: dict = {}
    for row in wanted.orderBy("item", "term").collect():
        of_item.setdefault(row["item"], []).append(row["term"])
    if not of_item:
        return []
    terms = sorted({t for found in of_item.values() for t in found})
    number = {t: i for i, t in enumerate(terms)}
    table = materialise(postings(docs, terms, key, text), "postings")
    sums = table.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
    total, length = sums["docs"], sums["length"] or 1
    holding = np.zeros(len(terms), np.int64)
    for row in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in holding.tolist()], np.int64)
    queries = [np.array([number[t] for t in found]) for found in of_item.values()]
    found = _search(table, queries, weights, total, length, k)
    items = spark.createDataFrame(list(enumerate(of_item)), T.StructType([
        T.StructField("number", T.IntegerType()), T.StructField("item", wanted.schema["item"].dataType)]))
    return [found.join(items, "number").select("item", "key", "score")]


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): the k best documents of each item, under the columns' own names.

    Queries go through the documents in passes of about ``TERMS_AT_ONCE`` terms. Keys of
    documents are whole numbers.
    """
    docs = docs.withColumn(key, F.col(key).cast("bigint"))
    wanted = materialise(query_terms(items, item, item_text), "query-terms")
    passes = -(-wanted.count() // TERMS_AT_ONCE)
    number = F.pmod(F.xxhash64("item"), F.lit(max(passes, 1)))
    none = T.StructType([wanted.schema["item"], T.StructField("key", T.LongType()), T.StructField("score", T.LongType())])
    found = docs.sparkSession.createDataFrame([], none)
    for p in range(passes):
        for part in _search_block(docs, wanted.where(number == p), key, text, k):
            found = found.union(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")

"""Quality rules with an n-gram language model of every language (operator 13).

Spark counts the 4-grams of bytes of all documents, language by language, and derives from them
a modified Kneser-Ney model: counts at the longest size, numbers of distinct left neighbours
below, three discounts of each size, and back-off weights of the contexts. The model's entries
are two sorted arrays, hashes and values. Documents are scored in bits per byte (the binary
logarithm of their perplexity per byte), and each language has a band about its median, wider for
shorter texts, from the quartiles of all its documents that pass the base rules; texts below it
(boilerplate, lists of few words) or above it (noise) are rejected.

Bytes and not words are the symbols, since the model must reach every document: the n-grams of
bytes that are in use saturate, while those of words grow with the corpus. The model is broadcast
only if it has at most ``BROADCAST_ENTRIES`` entries (16 bytes each); beyond, documents are dealt
to blocks by hash, and every block is joined with the entries that its texts ask for. Both ways
give the same scores.

Defined cases: a null text has no words and fails the base rules, as an empty one does; it has
no score. A null language is a language of its own. Each row is a document, also where rows repeat
a key; keys, null keys included, take no part. Bands are closed: a text at a limit stays. Empty
tables give an empty model and no rows. Columns of the input other than the three named are not
read. A text of any length is scored whole, by itself if it is long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tideline.llm import flat
from tideline.session import materialise

ORDER = 4                     # bytes of an n-gram
BITS = 9                      # of a symbol: a byte, or the start of a text
START = 256
TASK_ENTRIES = 4_000_000      # distinct n-grams a counting task holds before it passes them on
BROADCAST_ENTRIES = 4_000_000
BLOCK_BYTES = 32 << 20        # of text in a block, where the model is not broadcast
BELOW, ABOVE = 4.5, 6.0       # standard deviations from the median to the limits
LEAST_SPREAD = 0.005          # bits per byte; a class of like texts has no smaller deviation
QUARTILES = 1.349             # quartile distance of a normal distribution, in standard deviations

# The base rules.
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_IN_LINE = np.arange(256) != ord("\n")
_IS_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_U = np.uint64
FALLBACK = (0.5, 1.0, 1.5)    # discounts where too few counts are there to estimate them

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _seen_before(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which values are equal to an earlier one of the same text."""
    order = np.lexsort((key, doc))
    again = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    seen = np.zeros(len(key), dtype=bool)
    seen[order[1:]] = again
    return seen


def figures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The base figures of the texts ``data[offsets[i]:offsets[i + 1]]``, in the order of ``FIGURES``."""
    w = flat.words(data, offsets)
    base = int(offsets[0])
    bytes_, bounds = data[base:int(offsets[-1])], np.asarray(offsets) - base
    lines = flat.words(data, offsets, is_word=_IN_LINE)
    filled = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    line, line_doc = lines.hash[filled], lines.doc[filled]
    repeated = np.bincount(line_doc[_seen_before(line, line_doc)], minlength=w.n_docs)
    # Windows found twice or more cover their words.
    window = flat.grams(w.hash, REPEAT_WINDOW, seed=13)
    begin = np.flatnonzero(w.doc[:len(window)] == w.doc[REPEAT_WINDOW - 1:])
    _, at, times = np.unique(window[begin] ^ flat.mix(w.doc[begin].astype(_U)), return_inverse=True, return_counts=True)
    begin = begin[times[at] > 1]
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + REPEAT_WINDOW, -1)
    covered = w.doc[np.cumsum(cover)[:-1] > 0]
    return [w.counts(), _per_text(flat._IS_WORD[bytes_] & _IS_HEAD[bytes_], bounds),
            _per_text(_IS_SYMBOL[bytes_], bounds), repeated, np.bincount(covered, minlength=w.n_docs)]


def grams(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte, packed; starts stand before each text."""
    n, n_docs, before = len(data), len(bounds) - 1, ORDER - 1
    padded = np.full(n + before * n_docs, START, dtype=np.int64)
    place = np.arange(n) + np.repeat(before * np.arange(1, n_docs + 1), np.diff(bounds))
    padded[place] = data
    packed = np.zeros(max(len(padded) - before, 0), np.int64)
    for j in range(ORDER):
        packed <<= BITS
        packed |= padded[j:j + len(packed)]
    return packed[place - before]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(count, first) if len(first) else count


class _Languages:
    """Small codes for the languages a task has met."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.int64)

    def codes(self, language: np.ndarray) -> np.ndarray:
        self.hashes = np.concatenate([self.hashes, np.setdiff1d(language, self.hashes)])
        order = np.argsort(self.hashes)
        return order[np.searchsorted(self.hashes[order], language)]


def _texts(docs: DataFrame, text: str, lang: str, *keep: str) -> DataFrame:
    return docs.select(F.col(text).alias("text_"), F.xxhash64(F.col(lang).cast("string")).alias("language_"), *keep)


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(language, gram, n): the n-grams of all documents, counted within each task."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("language", "gram", "n")])
    shift = ORDER * BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = _Languages()
        held: list[list[np.ndarray]] = [[], []]

        def passed_on() -> pa.RecordBatch:
            key, count = _summed(*held)
            held[0].clear()
            held[1].clear()
            columns = (languages.hashes[key >> shift], key & _mask(ORDER), count)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema.names)

        for batch in batches:
            data, offsets = flat.text_buffers(batch.column(0))
            code = languages.codes(np.asarray(batch.column(1)))
            for i, j in flat.slices(offsets):
                part, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                key, count = np.unique(np.repeat(code[i:j], np.diff(bounds)) << shift | grams(part, bounds),
                                       return_counts=True)
                held[0].append(key)
                held[1].append(count)
                if sum(map(len, held[0])) > TASK_ENTRIES:
                    key, count = _summed(*held)
                    held[0][:], held[1][:] = [key], [count]
                    if len(key) > TASK_ENTRIES // 2:
                        yield passed_on()
        if held[0]:
            yield passed_on()

    return _texts(docs, text, lang).mapInArrow(run, schema)


# --- the model --------------------------------------------------------------------

def _mask(size: int) -> int:
    return (1 << (size * BITS)) - 1


def _discounts(level: DataFrame) -> DataFrame:
    """(language, d1, d2, d3) of the counts of one size."""
    having = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in range(1, 5)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    found = level.groupBy("language").agg(*having)
    # Division by zero gives NULL under try_divide, and so do too few counts.
    for i in (1, 2, 3):
        estimate = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        sound = (F.col("n1") > 0) & (estimate > 0) & (estimate < i)
        found = found.withColumn(f"d{i}", F.when(sound, estimate).otherwise(FALLBACK[i - 1]))
    return found.select(F.col("language").alias("of"), "d1", "d2", "d3")


def _entry(size: int, context: bool, gram: Column | str, chance: Column) -> list[Column]:
    value = F.log2(chance).cast("float").alias("value")
    return [F.lit(2 * size + context).cast("long").alias("slot"), F.col("language"), F.col(gram).alias("gram"), value]


def fit(counts: DataFrame) -> DataFrame:
    """(slot, language, gram, value) of a modified Kneser-Ney model, from :func:`count_grams`.

    Slot ``2 * size`` holds binary logarithms of interpolated probabilities, slot ``2 * size + 1``
    those of back-off weights by context. Every size is written once.
    """
    levels = {ORDER: materialise(counts.groupBy("language", "gram").agg(F.sum("n").alias("c")), f"grams-{ORDER}")}
    for size in range(ORDER - 1, 0, -1):
        shorter = levels[size + 1].select("language", F.col("gram").bitwiseAND(_mask(size)).alias("gram"))
        levels[size] = materialise(shorter.groupBy("language", "gram").agg(F.count(F.lit(1)).alias("c")), f"grams-{size}")
    entries, lower = [], None
    for size in range(1, ORDER + 1):
        level = levels[size]
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        # Written, so that Spark knows that it is small and needn't deal the n-grams by language.
        discounts = materialise(_discounts(level), f"discounts-{size}")
        # A context has at most 256 followers.
        beside = Window.partitionBy("language", "context")
        rows = (
            level.join(discounts, F.col("language") == F.col("of"))
            .select("language", "gram", "c", discount.alias("d"), F.shiftright("gram", BITS).alias("context"))
            .select("language", "gram", "context", (F.col("c") - F.col("d")).alias("rest"),
                    F.sum("c").over(beside).alias("all"), F.sum("d").over(beside).alias("taken"))
            .select("language", "gram", "context", (F.col("rest") / F.col("all")).alias("own"),
                    (F.col("taken") / F.col("all")).alias("backoff"))
        )
        if lower is None:
            rows = rows.withColumn("shorter", F.lit(1 / 256))
        else:
            below = lower.select(F.col("language").alias("of"), F.col("gram").alias("suffix"),
                                 F.col("chance").alias("shorter"))
            rows = rows.join(below, (F.col("language") == F.col("of"))
                             & (F.col("gram").bitwiseAND(_mask(size - 1)) == F.col("suffix")))
        lower = materialise(rows.select("language", "gram", "context", "backoff",
                                        (F.col("own") + F.col("backoff") * F.col("shorter")).alias("chance")),
                            f"chances-{size}")
        entries.append(lower.select(*_entry(size, False, "gram", F.col("chance"))))
        entries.append(lower.groupBy("language", "context").agg(F.first("backoff").alias("backoff")).select(
            *_entry(size, True, "context", F.col("backoff"))))
    model = entries[0]
    for part in entries[1:]:
        model = model.union(part)
    return model


def _hash(slot, language: np.ndarray, gram: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = flat.mix(language.astype(_U) + np.asarray(slot, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return flat.mix(gram.astype(_U) ^ salt)


@dataclass
class Entries:
    """Model entries as two arrays: sorted hashes and their values."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Entries:
        slot, language, gram, value = (np.asarray(table.column(c)) for c in ("slot", "language", "gram", "value"))
        hashes = _hash(slot, language, gram)
        order = np.argsort(hashes)
        return cls(hashes[order], value[order].astype(np.float32))

    def look(self, slot: int, language: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether an entry is there, its value)."""
        if not len(self.hashes):
            return np.zeros(len(gram), dtype=bool), np.zeros(len(gram), np.float32)
        wanted = _hash(slot, language, gram)
        place = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return self.hashes[place] == wanted, self.values[place]

    def bits(self, language: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each n-gram, backing off to shorter contexts."""
        total, waiting = np.zeros(len(gram)), np.arange(len(gram))
        for size in range(ORDER, 0, -1):
            found, value = self.look(2 * size, language[waiting], gram[waiting] & _mask(size))
            total[waiting[found]] -= value[found]
            waiting = waiting[~found]
            if not len(waiting):
                return total
            known, weight = self.look(2 * size + 1, language[waiting], (gram[waiting] >> BITS) & _mask(size - 1))
            total[waiting] -= np.where(known, weight, 0)
        total[waiting] += 8
        return total


def _scored_batch(batch: pa.RecordBatch, names: list[str], entries: Entries) -> pa.RecordBatch:
    """The batch with the base figures, ``n_bytes`` and ``bits``, in the columns ``names``."""
    have = dict(zip(batch.schema.names, batch.columns, strict=True))
    data, offsets = flat.text_buffers(have["text_"])
    language = np.asarray(have["language_"])
    kinds, code = np.unique(language, return_inverse=True)
    shift, found, bits = ORDER * BITS, [], []
    for i, j in flat.slices(offsets):
        found.append(figures(data, offsets[i:j + 1]))
        part, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        keys, at = np.unique(np.repeat(code[i:j], np.diff(bounds)) << shift | grams(part, bounds), return_inverse=True)
        each = entries.bits(kinds[keys >> shift], keys & _mask(ORDER))
        doc = np.repeat(np.arange(j - i), np.diff(bounds))
        bits.append(np.bincount(doc, weights=each[at], minlength=j - i))
    for k, name in enumerate(FIGURES):
        have[name] = pa.array(np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]), pa.int64())
    have["n_bytes"] = pa.array(np.diff(offsets), pa.int64())
    have["bits"] = pa.array(np.concatenate([np.zeros(0), *bits]))
    return pa.RecordBatch.from_arrays([have[n] for n in names], names)


def _scored_schema(rows: DataFrame) -> T.StructType:
    kept = [f for f in rows.schema.fields if f.name not in ("text_", "block_")]
    return T.StructType(kept + [T.StructField(n, T.LongType()) for n in [*FIGURES, "n_bytes"]]
                        + [T.StructField("bits", T.DoubleType())])


def _score_everywhere(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Score with the model on every executor: its size has been checked."""
    entries = Entries.of(model.toArrow())
    held = rows.sparkSession.sparkContext.broadcast((entries.hashes, entries.values))
    schema = _scored_schema(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _scored_batch(batch, schema.names, Entries(*held.value))

    return rows.mapInArrow(run, schema)


def _score_in_blocks(rows: DataFrame, model: DataFrame, blocks: int) -> DataFrame:
    """Score blocks of documents, each with the entries that it asks for."""
    # Numbered by row, so that copies spread over the blocks; written, so that a number stays.
    number = F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")
    rows = materialise(rows.withColumn("block_", number), "blocks")
    asked = _asked(rows.repartition(blocks, "block_").sortWithinPartitions("block_"))
    entries = asked.join(model, ["slot", "language", "gram"])
    schema = _scored_schema(rows)

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        entries = Entries.of(found)
        return pa.Table.from_batches([_scored_batch(b, schema.names, entries) for b in texts.to_batches()])

    return rows.groupBy("block_").cogroup(entries.groupBy("block_")).applyInArrow(run, schema)


def _asked(rows: DataFrame) -> DataFrame:
    """(block_, slot, language, gram): entries that may be needed to score each block, once each."""
    schema = T.StructType([rows.schema["block_"]] + [T.StructField(c, T.LongType()) for c in ("slot", "language", "gram")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.asarray(batch.column(0))
            data, offsets = flat.text_buffers(batch.column(2))
            language = np.asarray(batch.column(1))
            for i, j in flat.slices(offsets):
                part, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                # Documents of one block and language lie together in most slices.
                kinds, code = np.unique(np.stack([block[i:j], language[i:j]]), axis=1, return_inverse=True)
                keys = np.unique(np.repeat(code.ravel(), np.diff(bounds)) << (ORDER * BITS) | grams(part, bounds))
                kind, gram = keys >> (ORDER * BITS), keys & _mask(ORDER)
                for size in range(ORDER, 0, -1):
                    for slot, wanted in ((2 * size, gram & _mask(size)), (2 * size + 1, (gram >> BITS) & _mask(size - 1))):
                        both = np.unique(kind << (ORDER * BITS) | wanted)
                        k = both >> (ORDER * BITS)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(kinds[0][k], pa.int32()), pa.array(np.full(len(both), slot)),
                            pa.array(kinds[1][k]), pa.array(both & _mask(ORDER))], schema.names)

    return rows.select("block_", "language_", "text_").mapInArrow(run, schema).distinct()


def score(docs: DataFrame, model: DataFrame, text: str = "text", lang: str = "lang", *keep: str) -> DataFrame:
    """(keep, language_, base figures, n_bytes, bits) of every document."""
    rows = _texts(docs, text, lang, *keep)
    if model.count() <= BROADCAST_ENTRIES:
        return _score_everywhere(rows, model)
    size = rows.agg(F.sum(F.octet_length("text_"))).first()[0] or 0
    return _score_in_blocks(rows, model, -(-size // BLOCK_BYTES) or 1)


# --- rules ------------------------------------------------------------------------

def _rate() -> Column:
    """Bits per byte, NULL for a text without bytes."""
    return F.try_divide("bits", "n_bytes")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bands(scored: DataFrame) -> DataFrame:
    """(language_, median, fixed, by_length): each language's band, from all documents that pass the base rules.

    The variance of a text's rate about the median is ``fixed + by_length / n_bytes``: what texts differ
    by, and what the few bytes of a short text add by chance. Both are fitted to the quartile distances
    of length classes (doublings). Quartiles are exact to 0.001: rates are counted on that grid first.
    """
    grid = scored.where(~base_failed()).select(
        "language_", F.round(_rate(), 3).alias("rate"), F.floor(F.log2("n_bytes")).alias("size"),
        (1 / F.col("n_bytes")).alias("x"))
    table = grid.groupBy("language_", "size", "rate").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"))
    n = F.col("n")
    middle = table.groupBy("language_").agg(F.percentile("rate", 0.5, n).alias("median"))
    classes = table.groupBy("language_", "size").agg(
        F.percentile("rate", [0.25, 0.75], n).alias("q"), F.sum("n").alias("n"), (F.sum("x") / F.sum("n")).alias("x"))
    spread = F.greatest((F.col("q")[1] - F.col("q")[0]) / QUARTILES, F.lit(LEAST_SPREAD))
    # A straight line through the classes' variances; each weighs by its rows, errors relative to 1 / n_bytes.
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    sums = classes.select("language_", "x", (spread * spread).alias("y"), (n / (F.col("x") * F.col("x"))).alias("w")).groupBy(
        "language_").agg(F.sum(w).alias("s"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
                         F.sum(w * x * x).alias("sxx"), F.sum(w * x * y).alias("sxy"))
    slope = F.try_divide(F.expr("s * sxy - sx * sy"), F.expr("s * sxx - sx * sx"))
    line = sums.withColumn("slope", F.greatest(F.coalesce(slope, F.lit(0.0)), F.lit(0.0)))
    level = F.expr("(sy - slope * sx) / s")
    fitted = line.select(
        F.col("language_").alias("of"), F.greatest(level, F.lit(0.0)).alias("fixed"),
        F.when(level < 0, F.expr("sxy / sxx")).otherwise(F.col("slope")).alias("by_length"))
    return middle.join(fitted, F.col("language_") == F.col("of")).drop("of")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """(key, base figures, bits_per_byte, low, high, base_failed, kept) of every document.

    ``below`` and ``above`` are the limits in standard deviations of the language's texts of that length.
    """
    model = materialise(fit(count_grams(docs, text, lang)), "model")
    scored = materialise(score(docs, model, text, lang, key), "scores")
    # Written, as the discounts are: the join needn't deal the documents by language.
    limits = materialise(bands(scored).withColumnRenamed("language_", "of"), "bands")
    deviation = F.sqrt(F.col("fixed") + F.try_divide("by_length", "n_bytes"))
    judged = scored.join(limits, F.col("language_") == F.col("of"), "left").select(
        key, *FIGURES, _rate().alias("bits_per_byte"), (F.col("median") - below * deviation).alias("low"),
        (F.col("median") + above * deviation).alias("high"), base_failed().alias("base_failed"))
    inside = F.coalesce(F.col("bits_per_byte").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)

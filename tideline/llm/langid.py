"""Language identification by prediction by partial matching (operator 5).

Each language has a byte context tree of contexts of up to ``ORDER`` folded bytes. A byte is
coded in the longest context that has seen it; every longer context costs an escape, whose
share is distinct / (total + distinct) (method C). The statistics are frozen after fitting,
so the exact code length of each byte depends on the ``ORDER`` bytes before it alone, and
the trees become one table of code lengths per byte string and language. A text belongs to
the language that codes its letters in the fewest bits.

Bytes are folded first: capitals to small letters, digits to one symbol; of the rest the
``SYMBOLS`` - 1 most frequent in the sample stay, all others share a symbol.

The fit takes a documented sample: for each language the ``SAMPLE_DOCS`` labelled rows with
the smallest hash of their key, up to ``SAMPLE_BYTES``, a repeated text once; with more than
``MOST_LANGUAGES`` languages each gets its share of so many rows, one at least. Everything else
runs over all texts, whole.
A null text, or one without letters, is ``und`` with score 0. Ties go to the smaller name.
Rows that repeat a key are identified one by one. An empty table gives no rows; columns of the added
names are replaced, others pass through.
Without any labelled text all are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tideline.llm.flat import PART_BYTES, slices, string_column
from tideline.session import materialise

ORDER = 3
SYMBOLS = 32
SAMPLE_DOCS = 300
SAMPLE_BYTES = 2_000_000  # of one language at most, taken in the order of the hash; whole texts
MOST_LANGUAGES = 200  # languages that get that many; more of them share the budget of these rows equally
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[[9, 10, 11, 12, 13]] = 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True


def held_out(key: Column) -> Column:
    """Rows kept from fitting: crc32 of the key as text is divisible by 5."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def lettered(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script (Unicode categories L*).

    Characters are decoded only in texts without an ASCII letter, up to their first letter.
    """
    def some(marked: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marked)])[bounds]) > 0

    found = some(_LETTER[_FOLD[data]])
    for i in np.flatnonzero(~found & some(data >= 128)):
        characters = data[bounds[i]:bounds[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(map(str.isalpha, characters))
    return found


class ContextTrees:
    """Frozen code lengths: bits[language][s0 s1 .. sORDER] of the last symbol after the others."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        folded = {lang: _FOLD[np.frombuffer("\n".join(samples[lang]).encode(), dtype=np.uint8)]
                  for lang in self.languages}
        seen = sum((np.bincount(f, minlength=256) for f in folded.values()), np.zeros(256, np.int64))
        common = np.argsort(-seen, kind="stable")[:SYMBOLS - 1]
        self.symbol = np.full(256, SYMBOLS - 1, dtype=np.uint8)
        self.symbol[common[seen[common] > 0]] = np.flatnonzero(seen[common] > 0)
        self.symbol = self.symbol[_FOLD]
        self.bits = np.stack([self._lengths(self.symbol[f]) for f in folded.values()], axis=1) \
            if folded else np.zeros((SYMBOLS ** (ORDER + 1), 0), np.float32)

    @staticmethod
    def _lengths(symbols: np.ndarray) -> np.ndarray:
        """Code lengths of one language, from the shortest contexts to the longest."""
        symbols = symbols.astype(np.int64)
        chance = np.full(SYMBOLS, 1 / SYMBOLS)
        for order in range(ORDER + 1):
            code = np.zeros(max(len(symbols) - order, 0), np.int64)
            for j in range(order + 1):
                code = code * SYMBOLS + symbols[j:len(symbols) - order + j]
            counts = np.bincount(code, minlength=SYMBOLS ** (order + 1)).reshape(-1, SYMBOLS)
            total = counts.sum(axis=1, keepdims=True)
            distinct = (counts > 0).sum(axis=1, keepdims=True)
            # Contexts of one symbol less, repeated for each symbol put before them.
            shorter = np.tile(chance.reshape(-1, SYMBOLS), (max(len(counts) // max(chance.size // SYMBOLS, 1), 1), 1))
            whole = np.maximum(total + distinct, 1)
            escape = np.where(total > 0, distinct / whole, 1.0)
            chance = np.where(counts > 0, counts / whole, escape * shorter)
        return (-np.log2(chance)).ravel().astype(np.float32)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits of each text by language, whether it has a letter, its coded bytes)."""
        base, end = int(offsets[0]), int(offsets[-1])
        data, bounds = data[base:end], np.asarray(offsets) - base
        n, n_docs = len(data), len(bounds) - 1
        letters = lettered(data, bounds)
        bits = np.zeros((n_docs, len(self.languages)))
        if n and self.languages:
            space = int(self.symbol[32])
            # A text is coded as if spaces stood before it.
            sizes = np.diff(bounds)
            padded = np.full(n + ORDER * n_docs, space, dtype=np.int64)
            place = np.arange(n) + np.repeat(ORDER * np.arange(1, n_docs + 1), sizes)
            padded[place] = self.symbol[data]
            code = np.zeros(n, np.int64)
            for j in range(ORDER + 1):
                code = code * SYMBOLS + padded[place - ORDER + j]
            full = np.flatnonzero(sizes > 0)
            bits[full] = np.add.reduceat(self.bits[code], bounds[:-1][full], axis=0, dtype=np.float64)
        return bits, letters, np.diff(bounds)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> ContextTrees:
    """Trees fitted on the driver from the sample, whose size the parameters bound."""
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    which = ["lang", "key", "digest"]
    languages = rows.select("lang").distinct().count()
    share = max(1, SAMPLE_DOCS * min(MOST_LANGUAGES, languages) // max(languages, 1))
    order = Window.partitionBy("lang").orderBy("h", "key", "digest")
    hashed = rows.select("lang", "key", F.xxhash64("text").alias("digest"), F.octet_length("text").alias("size"),
                         F.xxhash64(F.col("key").cast("string")).alias("h"))
    # Rows that repeat are one text. Only the first rows of each language leave a task (a rank below a constant).
    distinct = hashed.groupBy(*which).agg(F.min("size").alias("size"), F.min("h").alias("h"))
    least = distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
    before = Window.partitionBy("lang").orderBy("rank")
    sized = least.withColumn("bytes", F.sum("size").over(before))
    chosen = materialise(sized.where((F.col("rank") == 1) | (F.col("bytes") <= SAMPLE_BYTES)).select(*which),
                         "language-sample")
    samples: dict[str, list[str]] = {}
    found = rows.withColumn("digest", F.xxhash64("text")).join(chosen, which).groupBy(*which).agg(F.min("text").alias("text"))
    for row in found.orderBy(*which).collect():
        samples.setdefault(row["lang"], []).append(row["text"])
    return ContextTrees(samples)


def identify(docs: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of the best language's likelihood) and
    ``bits_per_byte`` (code length in that language), which replace columns of these names."""
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "bits_per_byte": T.DoubleType()}
    fields = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType(fields + [T.StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*trees.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = string_column(batch, text)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
            for i, j in slices(offsets, PART_BYTES):
                bits, letters, size = trees.score(data, offsets[i:j + 1])
                known = letters & bool(trees.languages)
                at = bits.argmin(axis=1) if trees.languages else np.zeros(j - i, np.int64)
                least = bits.min(axis=1) if trees.languages else np.zeros(j - i)
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1).clip(1)
                best = np.where(known, at, len(names) - 1)
                values = [pa.array(names[best], pa.string()), pa.array(np.where(known, share, 0.0)),
                          pa.array(np.where(known, least / np.maximum(size, 1), 0.0))]
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in columns] + values, schema.names)

    return docs.mapInArrow(run, schema)

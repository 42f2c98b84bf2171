"""Byte-level BPE encoding and decoding by contiguous rank arrays (operator 8).

A word is held as the ids of its parts with the rank of every adjacent pair beside them.
Repeatedly the smallest rank is found by a scan, its boundary is deleted, and the ranks of
the two neighbouring pairs are looked up again. Words of one length class are handled
together as the rows of a matrix; a word longer than ``SHORT`` bytes uses a heap of ranks
over linked parts, as repeated scans would be quadratic there. Words repeat, so each worker
keeps what it has encoded (at most ``KEPT_WORDS``).

Null texts have no ids and decode to an empty text. A special token written out in a text
becomes its own id, as the vocabulary file asks. Rows are encoded one by one, also where they
repeat; an empty table gives no rows; a column of the added name is replaced, others pass through.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tideline.llm.flat import spread, worker_cache

SHORT = 48
KEPT_WORDS = 700_000
NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(extra)
            extra += 1
    return [symbols[b] for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes read from a vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids, symbols = model["model"]["vocab"], byte_symbols()
        self.pattern = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.byte_ids = np.array([ids[s] for s in symbols], dtype=np.int32)
        keys, ranks, merged = [], [], []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            keys.append(ids[left] << 32 | ids[right])
            ranks.append(rank)
            merged.append(ids[left + right])
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged_of_rank = np.array(merged, dtype=np.int32)
        self.ranks = np.array(ranks, dtype=np.int32)[order]
        self.rank_of = dict(zip(keys, ranks, strict=True))
    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE where they don't merge or a part is missing (-1)."""
        wanted = left.astype(np.int64) << 32 | right.astype(np.int64)
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[place] == wanted) & (right >= 0), self.ranks[place], NONE)

    def encode_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one word after another, number of ids of each) of words of about one length."""
        size = np.array([len(w) for w in words])
        width, rows = int(size.max()), len(words)
        columns = np.arange(width + 1)[None, :]
        parts = np.full((rows, width + 1), -1, dtype=np.int32)
        parts[columns < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ranks = self.pair_ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(rows, width)
        ended, rowid = [], np.arange(rows)
        while len(rowid):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rowid))
            least = ranks[each, at]
            over = least == NONE
            if over.any():
                ended.append((rowid[over], parts[over]))
                keep = ~over
                rowid, parts, ranks, at, least = rowid[keep], parts[keep], ranks[keep], at[keep], least[keep]
                each = np.arange(len(rowid))
            parts[each, at] = self.merged_of_rank[least]
            # Delete the boundary: all that follows moves one place left.
            moved = np.minimum(columns + (columns > at[:, None]), width)
            parts = np.take_along_axis(parts, moved, axis=1)
            parts[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(moved[:, :-1], width - 1), axis=1)
            ranks[:, -1] = NONE
            ranks[each, at] = self.pair_ranks(parts[each, at], parts[each, at + 1])
            left = at > 0
            i, p = each[left], at[left] - 1
            ranks[i, p] = self.pair_ranks(parts[i, p], parts[i, p + 1])
        final = np.empty((rows, width + 1), dtype=np.int32)
        for chosen, rest in ended:
            final[chosen] = rest
        return final[final >= 0], (final >= 0).sum(axis=1)

    def encode_long(self, word: bytes) -> np.ndarray:
        """The same merges for a long word: a heap of (rank, place) over linked parts."""
        parts = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(parts)
        following, previous = [*range(1, n), -1], [*range(-1, n - 1)]
        rank_of = self.rank_of
        heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = following[i]
            if parts[i] < 0 or j < 0 or rank_of.get(parts[i] << 32 | parts[j]) != rank:
                continue
            parts[i] = int(self.merged_of_rank[rank])
            parts[j] = -1
            following[i] = following[j]
            if following[i] >= 0:
                previous[following[i]] = i
            for a, b in ((previous[i], i), (i, following[i])):
                if a >= 0 and b >= 0 and (r := rank_of.get(parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of the words in the order done, all their ids, number of ids of each).

        Words are grouped by length so that matrices stay narrow.
        """
        order, ids, sizes = [], [], []
        classes: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > SHORT:
                order.append(np.array([i]))
                ids.append(self.encode_long(word))
                sizes.append(np.array([len(ids[-1])]))
            else:
                classes.setdefault((len(word) + 1) // 2, []).append(i)
        for members in classes.values():
            for low in range(0, len(members), 16_384):
                chosen = members[low:low + 16_384]
                flat, counts = self.encode_short([words[i] for i in chosen])
                order.append(np.array(chosen))
                ids.append(flat)
                sizes.append(counts)
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        return join(order, np.int64), join(ids, np.int32), join(sizes, np.int64)


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token id of a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    ids, of_symbol = model["model"]["vocab"], {s: b for b, s in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, number in ids.items():
        tokens[number] = bytes(of_symbol[c] for c in token)
    for token, number in special.items():
        tokens[number] = token.encode()
    return tokens


# Over these characters alone, the patterns of ``re`` and ``regex`` split alike.
_PLAIN = re.compile("[ -~\\n\\t\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u2018\u2019\u201c\u201d\u2013\u2014\u2026]*")
_CLASSES = {r"\p{L}+": r"[^\W\d_]+", r"\p{N}+": r"\d+", r"[^\s\p{L}\p{N}]+": r"(?:[^\s\w]|_)+"}


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for ``re``, which is faster; None if it uses other Unicode classes."""
    for general, simple in sorted(_CLASSES.items(), key=lambda c: -len(c[0])):
        pattern = pattern.replace(general, simple)
    return None if r"\p" in pattern else re.compile(pattern)


class Encoder:
    """Encodes texts, keeping the ids of words seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.plain = plain_pattern(vocabulary.pattern.pattern)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)  # ids of all kept words; the first ``used`` count
        self.used = 0
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        if self.plain is not None and _PLAIN.fullmatch(text):
            return self.plain.findall(text)
        return self.vocabulary.pattern.findall(text)

    def pieces(self, text: str) -> list[str]:
        v = self.vocabulary
        if v.splitter is None or not any(s in text for s in v.special):
            return self.split(text)
        found = []
        for part in v.splitter.split(text):
            found.extend([part] if part in v.special else self.split(part))
        return found

    def learn(self, words: list[str]) -> None:
        v = self.vocabulary
        for word in [w for w in words if w in v.special]:
            words.remove(word)
            self._keep([word], np.array([v.special[word]], np.int32), np.ones(1, np.int64))
        if words:
            order, ids, sizes = v.encode_words([w.encode("utf-8", "surrogatepass") for w in words])
            self._keep([words[i] for i in order.tolist()], ids, sizes)

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used += len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        if len(self.place) > KEPT_WORDS:
            self.forget()
        each = [self.pieces(t) for t in texts]
        self.learn(list(set(chain.from_iterable(each)).difference(self.place)))
        places = np.array(list(map(self.place.__getitem__, chain.from_iterable(each))), dtype=np.int64)
        sizes = self.size[places]
        ids = self.ids[np.repeat(self.begin[places], sizes) + spread(sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.cumsum([0, *map(len, each)])])


def _kept(key: tuple, make: Callable):
    """What ``make`` gave when this worker first asked for ``key``."""
    kept = worker_cache()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def _appended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _with(batch: pa.RecordBatch, name: str, values: pa.Array, names: list[str]) -> pa.RecordBatch:
    have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {name: values}
    return pa.RecordBatch.from_arrays([have[n] for n in names], names)


TEXTS_AT_ONCE = 256


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with its text replaced by a column ``ids`` of token ids (null text: no ids).

    ``path`` names the vocabulary file on every executor; an existing column ``ids`` is replaced.
    """
    source = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    schema = T.StructType([f for f in _appended(df, ids, T.ArrayType(T.IntegerType())).fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(("bpe", path, pattern), lambda: Encoder(Vocabulary(path, pattern)))
        for whole in batches:
            for low in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(low, TEXTS_AT_ONCE)
                flat, sizes = encoder.encode(batch.column(batch.schema.get_field_index(text)).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield _with(batch, ids, pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())), schema.names)

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with a column ``text`` decoded from its ids; broken UTF-8 becomes U+FFFD."""
    schema = _appended(df, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _kept(("tokens", path), lambda: token_bytes(path))
        for whole in batches:
            for low in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(low, TEXTS_AT_ONCE)
                column = batch.column(batch.schema.get_field_index(ids))
                counts = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
                flat = np.asarray(column.flatten()).tolist()
                ends = np.cumsum([0, *counts]).tolist()
                texts = [b"".join(map(tokens.__getitem__, flat[a:b])).decode("utf-8", "replace")
                         for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield _with(batch, text, pa.array(texts, pa.string()), schema.names)

    return df.mapInArrow(run, schema)

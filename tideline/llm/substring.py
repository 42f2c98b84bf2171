"""Substring dedup by windows that start earlier elsewhere, found through anchors (operator 1).

Dealt as relative Lempel-Ziv parsing; which words go is settled by equal hashes of windows, and the
factors are what these hits join to: there is no longest match and no greedy advance (README).
Every word that lies in a window of ``WINDOW`` words whose sequence also starts earlier
(smaller key, or same key and earlier start) is removed.

The reference is the whole corpus, indexed in blocks by content: a window is found through
its anchor, the run of ``ANCHOR`` words with the smallest hash in it, so about one word in
eight carries an entry and equal windows have equal anchors. An entry holds the stretch of
windows around it as a digest. Blocks are ranges of the anchor hash; each document meets
exactly the blocks that hold one of its anchors.

1. Entries with equal anchor and digest cover equal stretches: every one after the first is a
   factor that copies from the first. A scanning task settles those within its batch at once,
   so a passage in a third of all rows sends a row per batch, not per document.
2. An anchor with several digests lies at the boundary of factors. Only there, for the first
   entry of each digest, the single windows are compared.
3. In each document, matches of one source and one distance join greedily to factors, and
   the words of all factors go.

Words are compared by 64-bit hashes of anchor and of stretch or window together (128 bits).
Null texts and texts of fewer words than a window lose nothing; a null key takes no part.
Rows that repeat a key are taken as one document, so they don't remove each other's words.
Of equal windows the one with the smallest (key, start) stays. An empty table gives no rows; columns
other than key, text and those to carry are not read, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tideline.llm.flat import grams, mix, slices, string_column, text_buffers, words
from tideline.llm.packed import pack_texts, unpack
from tideline.session import materialise

WINDOW = 20
ANCHOR = 6
SEED_ANCHOR, SEED_WINDOW, SEED_DIGEST = 101, 202, 303

ENTRY = pa.schema([
    ("anchor", pa.int64()), ("digest", pa.int64()), ("key", pa.int64()), ("start", pa.int32()),
    ("windows", pa.int32()), ("ref_key", pa.int64()), ("ref_start", pa.int32()), ("settled", pa.bool_())])
ENTRY_SQL = ("anchor long, digest long, key long, start int, windows int, ref_key long, ref_start int, "
             "settled boolean")


def _stretches(hashes: np.ndarray, doc: np.ndarray, window: int, anchor: int) -> dict[str, np.ndarray]:
    """The stretches of a slice: runs of windows that share an anchor."""
    n = len(hashes) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return {"first": none, "count": none, "anchor": none.astype(np.uint64), "digest": none.astype(np.uint64)}
    short = grams(hashes, anchor, SEED_ANCHOR)
    least, at = short[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, window - anchor + 1):
        here = short[j:j + n]
        better = here < least
        at[better] = j
        np.copyto(least, here, where=better)
    at += np.arange(n)
    valid = doc[:n] == doc[window - 1:]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return {"first": none, "count": none, "anchor": none.astype(np.uint64), "digest": none.astype(np.uint64)}
    place = at[starts]
    fresh = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first = starts[fresh]
    count = np.diff(np.concatenate([fresh, [len(starts)]]))
    long = mix(grams(hashes, window, SEED_WINDOW) ^ np.uint64(SEED_DIGEST))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(long, dtype=np.uint64)])
    offset = (place[fresh] - first).astype(np.uint64)
    digest = mix(sums[first + count] - sums[first] + mix(offset * np.uint64(1024) + count.astype(np.uint64)))
    return {"first": first, "count": count, "anchor": short[place[fresh]], "digest": digest}


def _settle(k1: np.ndarray, k2: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, number in that order of the first row of each row's (k1, k2) run)."""
    order = np.lexsort((start, key, k2, k1))
    a, b = k1[order], k2[order]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    return order, np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))


def _entries(anchor, digest, key, start, windows) -> pa.RecordBatch:
    """Rows of one batch, with all that repeat an earlier row of it settled."""
    order, head = _settle(anchor, digest, key, start)
    anchor, digest, key, start, windows = (x[order] for x in (anchor, digest, key, start, windows))
    settled = np.arange(len(order)) != head
    ref_key, ref_start = key[head], start[head]
    real = ~settled | (ref_key != key) | (ref_start != start)  # not a row of a repeated key
    # Settled rows pass through the index; they are dealt by key, not to the hot anchor.
    anchor = np.where(settled, mix(key.view(np.uint64)), anchor)
    arrays = (anchor.view(np.int64), digest.view(np.int64), key, start.astype(np.int32), windows.astype(np.int32),
              ref_key, ref_start.astype(np.int32), settled)
    return pa.RecordBatch.from_arrays([pa.array(x[real]) for x in arrays], schema=ENTRY)


def _index_entries(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_column(batch, "text")
            keys = np.asarray(batch.column(0))
            found = []
            for i, j in slices(offsets):
                w = words(data, offsets[i:j + 1])
                s = _stretches(w.hash, w.doc, window, anchor)
                of = w.doc[s["first"]]
                found.append((s["anchor"], s["digest"], keys[i:j][of], s["first"] - w.firsts()[of], s["count"]))
            if found:
                yield _entries(*[np.concatenate(x) for x in zip(*found, strict=True)])

    return docs.where("key is not null").select("key", "text").mapInArrow(run, ENTRY_SQL)


SPAN_SQL = "key long, start int, windows int, ref_key long, ref_start int, anchor long"
SPAN = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("ref_key", pa.int64()),
                  ("ref_start", pa.int32()), ("anchor", pa.int64())])


def _match(sorted_entries: DataFrame) -> DataFrame:
    """Walk the entries of an index block in order of (anchor, digest, key, start).

    Gives the matches, and with a null ``ref_key`` the stretches whose windows must be
    compared one by one. Only the first row of a run is remembered, however long it is.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "digest", "key", "start", "windows"]
        head: list[np.ndarray] | None = None  # the first row of the last run, as arrays of one
        pending = False  # the last run shares its anchor with the one before
        for batch in batches:
            settled = np.asarray(batch.column(7).to_numpy(zero_copy_only=False))
            passed = batch.filter(pa.array(settled)).select(["key", "start", "windows", "ref_key", "ref_start", "anchor"])
            if passed.num_rows:
                yield pa.RecordBatch.from_arrays(passed.columns, schema=SPAN)
            rows = [np.asarray(batch.column(i))[~settled] for i in range(5)]
            if not len(rows[0]):
                continue
            carried = head is not None
            if carried:
                rows = [np.concatenate([h, r]) for h, r in zip(head, rows, strict=True)]
            anchor, digest, key, start, windows = rows
            fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])])
            first = np.flatnonzero(fresh)
            of = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            copies = np.flatnonzero(~fresh & ((key[of] != key) | (start[of] != start)))
            same_next = anchor[first[1:]] == anchor[first[:-1]]
            mixed = np.concatenate([same_next, [False]]) | np.concatenate([[pending and carried], same_next])
            pending = bool(mixed[-1])
            head = [r[first[-1:]] for r in rows]
            ask = first[:-1][mixed[:-1]]
            yield _spans([x[copies] for x in (key, start, windows)], key[of[copies]], start[of[copies]], anchor[copies])
            if len(ask):
                yield _spans([x[ask] for x in (key, start, windows)], None, None, anchor[ask])
        if head is not None and pending:
            yield _spans([head[names.index(n)] for n in ("key", "start", "windows")], None, None, head[0])

    return sorted_entries.mapInArrow(run, SPAN_SQL)


def _spans(own: list[np.ndarray], ref_key, ref_start, anchor) -> pa.RecordBatch:
    n = len(own[0])
    return pa.RecordBatch.from_arrays([
        *[pa.array(x, t) for x, t in zip(own, (pa.int64(), pa.int32(), pa.int32()), strict=True)],
        pa.nulls(n, pa.int64()) if ref_key is None else pa.array(ref_key, pa.int64()),
        pa.nulls(n, pa.int32()) if ref_start is None else pa.array(ref_start, pa.int32()),
        pa.array(anchor, pa.int64())], schema=SPAN)


def _windows_asked(texts: DataFrame, window: int) -> DataFrame:
    """The single windows of the asked stretches, as entries (anchor, window hash) of one window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(pa.array(unpack(batch.column(1).to_pylist()), pa.large_binary())
                                         .cast(pa.large_string()))
            keys = np.asarray(batch.column(0))
            asked = batch.column(2)
            flat = asked.flatten()
            many = np.diff(np.asarray(asked.offsets))
            row = np.repeat(np.arange(batch.num_rows), many)
            first, count, anchor = (np.asarray(flat.field(k)) for k in range(3))
            bound = np.cumsum(np.concatenate([[0], many]))
            found = []
            for i, j in slices(offsets):
                w = words(data, offsets[i:j + 1])
                long = grams(w.hash, window, SEED_WINDOW)
                here = slice(bound[i], bound[j])
                n = count[here].astype(np.int64)
                at = np.repeat(first[here].astype(np.int64), n)
                at += np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                of = np.repeat(row[here] - i, n)
                found.append((np.repeat(anchor[here], n).view(np.uint64), long[w.firsts()[of] + at], keys[i:j][of], at,
                              np.ones(len(at), np.int64)))
            if found:
                yield _entries(*[np.concatenate(x) for x in zip(*found, strict=True)])

    return texts.mapInArrow(run, ENTRY_SQL)


FACTOR = "struct<start:int,length:int,ref_key:bigint,ref_start:int>"


def _factors(start, length, ref_key, ref_start) -> tuple[np.ndarray, ...]:
    """Matches of a text joined greedily: those of one source and distance that touch are one factor."""
    start, length, ref_key, ref_start = (x.astype(np.int64) for x in (start, length, ref_key, ref_start))
    away = start - ref_start
    order = np.lexsort((start, away, ref_key))
    start, length, ref_key, ref_start, away = (x[order] for x in (start, length, ref_key, ref_start, away))
    apart = (ref_key[1:] != ref_key[:-1]) | (away[1:] != away[:-1]) | (start[1:] > (start + length)[:-1])
    first = np.flatnonzero(np.concatenate([[True], apart]))
    end = np.maximum.reduceat(start + length, first)
    return start[first], end - start[first], ref_key[first], ref_start[first]


def _removed(texts: DataFrame, window: int, untouched: bool) -> DataFrame:
    carried = [f for f in texts.schema.fields if f.name not in ("key", "packed", "spans")]
    texts = texts.select("key", "packed", "spans", *[f.name for f in carried])
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("factors", T.ArrayType(T._parse_datatype_string(FACTOR))), *carried])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_key", pa.int64()),
                                ("ref_start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                totals, gone, kept, factors = [], [], [], []
                for text, spans in zip(unpack(batch.column(1).to_pylist()), batch.column(2), strict=True):
                    parts = text.split()
                    totals.append(len(parts))
                    found = []
                    if spans.is_valid and len(spans.values):
                        v = spans.values
                        start, windows, ref_key, ref_start = (np.asarray(v.field(k)) for k in range(4))
                        f = _factors(start, windows.astype(np.int64) + window - 1, ref_key, ref_start)
                        step = np.zeros(len(parts) + 1, np.int64)
                        np.add.at(step, f[0], 1)
                        np.add.at(step, np.minimum(f[0] + f[1], len(parts)), -1)
                        stay = np.cumsum(step)[:-1] == 0
                        parts = [p for p, s in zip(parts, stay.tolist(), strict=True) if s]
                        found = [dict(zip(("start", "length", "ref_key", "ref_start"), r, strict=True))
                                 for r in sorted(zip(*[x.tolist() for x in f], strict=True))]
                    gone.append(totals[-1] - len(parts))
                    whole_text = untouched and not gone[-1]
                    kept.append((text if whole_text else b" ".join(parts)).decode("utf-8", "replace"))
                    factors.append(found)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                    pa.array(kept, pa.string()), pa.array(factors, arrow), *batch.columns[3:]], schema.names)

    return texts.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, carry: Sequence[str] = (), untouched: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept, factors, carried columns) of every row.

    ``kept`` joins the words that stay by one space; with ``untouched`` a text that loses none stays as it
    is, white space included. ``factors`` are the removed ranges: first
    word, length, and where they were copied from.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    whole = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                        *[F.col(name).alias(f"c{i}") for i, name in enumerate(carry)])
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def in_blocks(entries: DataFrame) -> DataFrame:
        return entries.repartition(blocks, "anchor").sortWithinPartitions("anchor", "digest", "key", "start")

    found = materialise(_match(in_blocks(_index_entries(rows, window, anchor))), "matches")
    asked = found.where("ref_key is null").groupBy("key").agg(
        F.collect_list(F.struct("start", "windows", "anchor")).alias("asked"))
    texts = pack_texts(rows.where("key is not null"))
    # Merge joins keep the two steps in Python of either side apart: a task then occupies one worker, not two.
    single = _match(in_blocks(_windows_asked(texts.join(asked.hint("merge"), "key"), window)))
    matches = found.union(single).where("ref_key is not null").groupBy("key").agg(
        F.collect_list(F.struct("start", "windows", "ref_key", "ref_start")).alias("spans"))
    done = _removed(pack_texts(whole).join(matches.hint("merge"), "key", "left"), window, untouched)
    return done.select(F.col("key").alias(key), "n_words", "n_removed", "kept", "factors",
                       *[F.col(f"c{i}").alias(name) for i, name in enumerate(carry)])

"""Exact n-gram Jaccard join by universe partition (operator 9).

A document's set holds the distinct runs of ``N`` lower-cased words (A-Z only); a shorter
text has its whole sequence as one member, a text without words none. Two documents link
when 100 * intersection >= ``PERCENT`` * union; the result gives connected documents a class.

Sizes fall into bands of a factor ``BAND``; each band has its number of segments, and a hash
deals the members of a set to them. Partners of a set of s members differ from it in at most
H = (s + largest partner) * (100 - PERCENT) / (100 + PERCENT) members, and each spoils one
segment at most, so H + 1 segments of a set hold one that both share (pigeonhole). A set whose
largest partner lies in the next band is indexed there too. What is indexed is allocated by cost:

* H + 1 of the non-empty segments, in one order for all sets: segments with a rare member
  first, then by hash. Frequent members are found by a count over all documents; they change
  the cost, never the result. A share ``EXTRA`` of H more can be indexed beside them: two sets
  that link then have as many entries in common, and one, and pairs with fewer are not compared.
* A set with H non-empty segments or fewer indexes all of them, and beside each the
  neighbourhood with one member deleted: a segment of several members then bears one
  difference, and only two spoil it.
  Such a set asks for a single common entry.
* If that is still not enough (nearly all members in one segment), every member by itself.

Equal sets are one class from the start. Members of an index entry are compared exactly with
its first member: each text with the smallest of these first, then with all of them that it
isn't tied to; then every two members of different components in an entry: pair by pair where
components are few, else in blocks, by sketches first and by texts where many may link. Entries with
the same keys count as one, and large ones that overlap are united for the last step. So no link
between components is lost, while a group of near copies costs a comparison per document. Texts are
compared only where the sizes and a sketch of each set (bucket counts, which bound the
intersection from above) allow a link.
Rows stream through sorted index blocks, so an entry of any size fits a task; equal sets of a
scanning batch are indexed once.

Null keys take no part and have a null component; rows that share a key are one document. Texts at
the very threshold link. An empty table gives no rows; columns other than key and text are not
read, so their names may clash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideline.llm.components import components, labels
from tideline.llm.flat import grams, mix, slices, string_column, text_buffers, words
from tideline.llm.packed import packed, unpack
from tideline.session import materialise

N = 5
PERCENT = 75
BAND = 4
EXTRA = 0.0  # share of the entries a partner can spoil that is indexed beside H + 1
FILL = 1.5  # mean members of a segment for the largest sets of a band
FREQUENT = 2048  # a member is frequent if one document in so many has it
MOST_FREQUENT = 1 << 17  # bounds what is sent to every task
ROW_KEYS = 256  # an entry of more members is dealt over several rows
CROWD = 16  # entries of more components are compared in blocks
BLOCK = 768
PAIRS_EACH = 4  # possible pairs for each member of a chunk pair, above which its texts are compared all together
TOKENS_AT_ONCE = 8192
ROWS_A_FILE = 1 << 14  # documents for each task that writes a derived table, if there are more than cores
BITMAP = 1 << 25  # hashes of keys, of which a bit each is sent to every task
_U = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(member, number of the text) of the distinct members of each text of a slice, in text order."""
    w = words(data, offsets, lower=True)
    counts, first = w.counts(), w.firsts()
    runs = grams(w.hash, n, 5000 + n)
    whole = w.doc[:len(runs)] == w.doc[n - 1:] if len(runs) else np.zeros(0, bool)
    member, doc = [runs[whole]], [w.doc[:len(runs)][whole]]
    for k in range(1, n):
        few = np.flatnonzero(counts == k)
        if len(few):
            member.append(grams(w.hash, k, 5000 + k)[first[few]])
            doc.append(few)
    member, doc = np.concatenate(member), np.concatenate(doc)
    key = mix(member ^ mix(doc.astype(_U)))
    order = np.argsort(key, kind="stable")
    k, m, d = key[order], member[order], doc[order]
    fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (d[1:] != d[:-1])])[:len(k)]
    keep = np.zeros(len(key), bool)
    keep[order[fresh]] = True
    member, doc = member[keep], doc[keep]
    order = np.argsort(doc, kind="stable")
    return member[order], doc[order]


def _sums(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    return total[ends[1:]] - total[ends[:-1]]


def _set_hashes(member: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(mix(_sums(mix(member ^ _U(seed)), doc, n_docs)) for seed in (11, 12))


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, bytes, offsets) of the slices of a (key, text) batch."""
    data, offsets = string_column(batch, "text")
    keys = np.asarray(batch.column(0))
    for i, j in slices(offsets):
        yield keys[i:j], data, offsets[i:j + 1]


def _sketch(own: np.ndarray) -> bytes:
    """How many members fall into each of about size / 3 buckets, a byte each."""
    width = 1 << max(int(len(own)).bit_length() - 2, 0)
    counts = np.bincount((own & _U(width - 1)).astype(np.int64), minlength=width)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def describe(rows: DataFrame, n: int = N) -> DataFrame:
    """(key, size, h1, h2, sketch): size, hash and bucket counts of each text's set."""
    schema = "key long, size long, h1 long, h2 long, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sketches = [], []
            data, offsets = string_column(batch, "text")
            for i, j in slices(offsets):
                member, doc = shingles(data, offsets[i:j + 1], n)
                size = np.bincount(doc, minlength=j - i)
                parts.append([size, *[h.view(np.int64) for h in _set_hashes(member, doc, j - i)]])
                ends = np.concatenate([[0], np.cumsum(size)])
                sketches += [_sketch(member[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            if parts:
                columns = [pa.array(np.concatenate(p), pa.int64()) for p in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(sketches, pa.binary())],
                                                 ["key", "size", "h1", "h2", "sketch"])

    return rows.mapInArrow(run, schema)


def _often(parts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, count) of the values that occur ``least`` times or more in ``parts``, which are emptied.

    Sorted in place: next to the values themselves only a bit each is held.
    """
    values = np.concatenate(parts)
    parts.clear()
    values.sort()
    last = len(values) - least + 1
    found = np.unique(values[:max(last, 0)][values[least - 1:] == values[:max(last, 0)]])
    return found, np.searchsorted(values, found, side="right") - np.searchsorted(values, found)


def frequent_members(rows: DataFrame, n: int = N) -> np.ndarray:
    """Members of at least one document in FREQUENT, sorted; counted over all texts.

    A batch passes on what is frequent in it; a frequent member may be missed if it gathers
    nowhere, which only costs time; so does the bound MOST_FREQUENT.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple] = set()
            found = []
            for keys, data, offsets in _text_slices(batch):
                member, doc = shingles(data, offsets, n)
                # Equal sets count once: they are one class whatever they hold.
                fresh = []
                for h in zip(*[h.tolist() for h in _set_hashes(member, doc, len(keys))], strict=True):
                    fresh.append(h not in seen)
                    seen.add(h)
                found.append(member[np.array(fresh, bool)[doc]])
            if found:
                member, count = _often(found, max(4, batch.num_rows // (2 * FREQUENT)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(member.view(np.int64)), pa.array(count, pa.int64())], ["member", "n"])

    least = rows.count() / FREQUENT
    counts = rows.mapInArrow(run, "member long, n long").groupBy("member").agg(F.sum("n").alias("n"))
    most = counts.where(F.col("n") >= max(least, 8)).orderBy(F.desc("n"), "member").limit(MOST_FREQUENT)
    return np.sort(np.array([r["member"] for r in most.select("member").collect()], dtype=np.int64).view(_U))


def largest_partner(size: np.ndarray, percent: int) -> np.ndarray:
    return size * 100 // percent


def _band(size: np.ndarray) -> np.ndarray:
    """Largest b with BAND ** b <= size."""
    edges = BAND ** np.arange(1, 26, dtype=np.int64)
    return np.searchsorted(edges, size, side="right")


def _distinct_rows(sig: np.ndarray, doc: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((need, sig, doc))
    sig, doc, need = sig[order], doc[order], need[order]
    fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])])[:len(sig)]
    return sig[fresh], doc[fresh], need[fresh]


def signatures(member: np.ndarray, doc: np.ndarray, size: np.ndarray, frequent: np.ndarray,
               percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature, number of the set) of all index entries of the sets of a slice."""
    return entries_of(member, doc, size, frequent, percent)[:2]


def entries_of(member: np.ndarray, doc: np.ndarray, size: np.ndarray, frequent: np.ndarray,
               percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, and how many entries a partner must have in common with the set.

    The number is negative on the entries that are only there to be counted: two sets that link
    also have one of the others in common.
    """
    sig, of, need = [], [], []
    band, partner = _band(size), largest_partner(size, percent)
    rare = np.ones(len(member), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, member), len(frequent) - 1)
        rare = frequent[at] != member
    for above in (0, 1):
        level = band + above
        bound = BAND ** (level + 1).astype(np.int64) - 1
        reach = np.minimum(partner, bound)
        used = (size > 0) & ((above == 0) | (partner > BAND ** level.astype(np.int64) - 1))
        differing = (size + reach) * (100 - percent) // (100 + percent)
        segments = np.ceil((bound + 1) / FILL).astype(np.int64)
        take = used[doc]
        m, d, r = member[take], doc[take], rare[take]
        if not len(m):
            continue
        salt = mix(level.astype(_U) + _U(77))[d]
        part = mix(m ^ salt) % segments[d].astype(_U)
        value = mix(m + salt)
        order = np.lexsort((part, d))
        m, d, r, part, value, salt = m[order], d[order], r[order], part[order], value[order], salt[order]
        first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (d[1:] != d[:-1])]))
        total = np.add.reduceat(value, first)
        count = np.diff(np.concatenate([first, [len(m)]]))
        seg_doc = d[first]
        exact = mix(total ^ mix(part[first] + salt[first]))
        common = ~np.logical_or.reduceat(r, first)
        filled = np.bincount(seg_doc, minlength=len(size))
        order = np.lexsort((exact, common, seg_doc))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - (np.cumsum(filled) - filled)[seg_doc[order]]
        extra = (differing * EXTRA).astype(np.int64)
        chosen = rank <= (differing + extra)[seg_doc]
        # Each difference spoils a segment at most: this many of the first ones stay in common.
        common_entries = np.maximum(np.minimum(1 + extra, filled - differing), 1)
        sig.append(exact[chosen])
        of.append(seg_doc[chosen])
        asked = common_entries[seg_doc[chosen]]
        need.append(np.where(rank[chosen] <= differing[seg_doc[chosen]], asked, -asked))
        short = used & (filled <= differing)
        if short.any():
            near = short[seg_doc]
            sig.append(mix(exact[near] ^ _U(1)))
            of.append(seg_doc[near])
            several = np.repeat(near & (count > 1), count)
            seg = np.repeat(np.arange(len(first)), count)[several]
            sig.append(mix(mix((total[seg] - value[several]) ^ mix(part[first][seg] + salt[first][seg])) ^ _U(1)))
            of.append(seg_doc[seg])
            weight = np.bincount(seg_doc, np.minimum(count, 2), minlength=len(size))
            single = (short & (weight <= differing))[d]
            sig.append(mix(value[single] ^ _U(2)))
            of.append(d[single])
            need.extend(np.ones(len(v), np.int64) for v in of[-3:])
    if not sig:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _distinct_rows(np.concatenate(sig), np.concatenate(of), np.concatenate(need))


def _index_entries(rows: DataFrame, frequent: np.ndarray, n: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            for keys, data, offsets in _text_slices(batch):
                member, doc = shingles(data, offsets, n)
                size = np.bincount(doc, minlength=len(keys))
                h1, h2 = _set_hashes(member, doc, len(keys))
                # Equal sets are tied by their hash; one of them in a batch is enough here.
                again = [seen.setdefault(h, k) != k
                         for h, k in zip(zip(h1.tolist(), h2.tolist(), strict=True), keys.tolist(), strict=True)]
                size[np.array(again, bool)] = 0
                take = size[doc] > 0
                sig, of, need = entries_of(member[take], doc[take], size, frequent, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(keys[of], pa.int64()), pa.array(need, pa.int32())],
                    ["sig", "key", "need"])

    return rows.mapInArrow(run, "sig long, key long, need int")


def _walked(sorted_entries: DataFrame) -> DataFrame:
    """(sig, keys, needs, leader, leader_need) of entries with several keys, walked in order of (sig, key).

    A row holds all members of an entry and neither signature nor leader; an entry of more than
    ``ROW_KEYS`` is dealt over rows with both, so that no more of it is held.
    """
    def rows(sig, leader, key, need, sizes):
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((key, pa.int64()), (need, pa.int32()))]
        told = [pa.array([v] * len(sizes), t) for v, t in zip((sig, *leader), (pa.int64(), pa.int64(), pa.int32()), strict=True)]
        return pa.RecordBatch.from_arrays([told[0], *lists, *told[1:]], ["sig", "keys", "needs", "leader", "leader_need"])

    def long_rows(sig, leader, key, need):
        for at in range(0, len(key), ROW_KEYS):
            part = key[at:at + ROW_KEYS]
            yield rows(sig, leader, part, need[at:at + ROW_KEYS], [len(part)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # held: the rows of the last entry; once it is a long one, leader is set and only its last row, given before, is held.
        held, leader = None, None
        for batch in itertools.chain(batches, [None]):
            columns = [] if batch is None else [[np.asarray(batch.column(i)) for i in range(3)]]
            columns = ([held] if held else []) + columns
            if not columns:
                continue
            sig, key, need = (np.concatenate(c) for c in zip(*columns, strict=True))
            if not len(sig):
                continue
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
            sig, key, need = sig[fresh], key[fresh], need[fresh]
            begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            ends = np.append(begins[1:], len(sig))
            done = np.ones(len(begins), bool)
            if leader:
                yield from long_rows(sig[0].item(), leader, key[1:ends[0]], need[1:ends[0]])
                done[0] = False
            if batch is not None:
                done[-1] = False
            sizes = ends - begins
            whole = done & (sizes > 1) & (sizes <= ROW_KEYS)
            if whole.any():
                of = np.repeat(whole, sizes)
                yield rows(None, (None, None), key[of], need[of], sizes[whole])
            last = len(begins) - 1
            for at in np.flatnonzero(~whole & (sizes > ROW_KEYS)).tolist():
                if not (at == 0 and leader):
                    i, j = begins[at], ends[at]
                    yield from long_rows(sig[i].item(), (key[i].item(), need[i].item()), key[i:j], need[i:j])
            i = begins[last]
            if not (last == 0 and leader):
                leader = (key[i].item(), need[i].item()) if sizes[last] > ROW_KEYS else None
            if leader:
                i = len(sig) - 1
            held = (sig[i:], key[i:], need[i:])

    return sorted_entries.mapInArrow(run, "sig long, keys array<long>, needs array<int>, leader long, leader_need int")


def _shared(walked: DataFrame) -> DataFrame:
    """(sig, key, need, leader, leader_need, times): entries of the same keys once, and how many these are.

    They would only ask for the same comparisons. Near copies have nearly all their entries in
    common, so what follows grows with the sets of texts that meet, not with their entries.
    """
    once = walked.groupBy("sig", "leader", "leader_need", "keys", "needs").agg(F.count(F.lit(1)).alias("times"))
    first = lambda column, values: F.coalesce(column, F.element_at(values, 1)).alias(column)
    return once.select(
        F.coalesce("sig", F.xxhash64("keys", "needs")).alias("sig"), first("leader", "keys"), first("leader_need", "needs"),
        "times", F.explode(F.arrays_zip("keys", "needs")).alias("member"),
    ).select("sig", F.col("member.keys").alias("key"), F.col("member.needs").alias("need"), "leader", "leader_need", "times")


def _most_shared(a: bytes, b: bytes) -> int | None:
    """The most members two sets can share by their sketches; None if a count is full."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if x.max() == 255 or y.max() == 255:
        return None
    width = min(len(x), len(y))
    x, y = (v.reshape(-1, width).sum(axis=0, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum())


def _alike(one: str, other: str, percent: int) -> Column:
    """Whether the sizes of two sets allow a link."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches allow to link; no link is lost."""
    both = pairs.join(sketches.toDF("a", "size_a", "x"), "a").join(sketches.toDF("b", "size_b", "y"), "b").where(
        _alike("size_a", "size_b", percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = []
            for size_a, x, size_b, y in zip(*columns, strict=True):
                most = _most_shared(x, y)
                keep.append(most is None or 100 * most >= percent * (size_a + size_b - most))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "size_a", "x", "size_b", "y").mapInArrow(run, "a long, b long")


def _sets(raw: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, number of the text) of texts, made slice by slice."""
    data, offsets = text_buffers(pa.array(raw, pa.large_binary()).cast(pa.large_string()))
    parts = [(np.zeros(0, _U), np.zeros(0, np.int64))]
    for i, j in slices(offsets):
        member, doc = shingles(data, offsets[i:j + 1], n)
        parts.append((member, doc + i))
    member, doc = zip(*parts, strict=True)
    return np.concatenate(member), np.concatenate(doc)


def _among(rows: DataFrame, wanted: DataFrame, pack: bool = False) -> DataFrame:
    """The rows whose key may be among ``wanted`` (key): a bitmap of ``BITMAP`` hashes sorts most others out.

    So what is not asked for stays out of the shuffle; with very many keys asked for, more passes.
    With ``pack`` the texts are compressed in the same step, which takes one Python worker a task, not two.
    """
    bit = F.pmod(F.xxhash64("key"), F.lit(BITMAP))
    pages = wanted.select(bit.alias("bit")).groupBy((F.shiftright("bit", 15)).alias("page")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits")).collect()
    bitmap = np.zeros(BITMAP // 8, np.uint8)
    for page, bits in pages:
        bitmap[page << 12:(page + 1) << 12] = np.frombuffer(bits, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("bit"))
            found = batch.filter(pa.array((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)).select(["key", "text"])
            yield pa.RecordBatch.from_arrays([found.column(0), packed(found.column(1))], ["key", "packed"]) if pack else found

    return rows.select("key", "text", bit.alias("bit")).mapInArrow(run, f"key long, {'packed binary' if pack else 'text string'}")


def _byte_slices(column: pa.Array, budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of a column of compressed texts, of about ``budget`` bytes."""
    return slices(np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)))]), budget)


PAIR_BYTES = 1 << 19  # of compressed texts of one side compared at once


def _linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared exactly."""
    both = (pairs.join(texts.select(F.col("key").alias("a"), F.col("packed").alias("x")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("packed").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in _byte_slices(whole.column(2), PAIR_BYTES):
                batch = whole.slice(low, high - low)
                rows = batch.num_rows
                (xm, xd), (ym, yd) = (_sets(unpack(batch.column(i).to_pylist()), n) for i in (2, 3))
                member, pair = np.concatenate([xm, ym]), np.concatenate([xd, yd])
                order = np.lexsort((member, pair))
                m, p = member[order], pair[order]
                inter = np.bincount(p[1:][(m[1:] == m[:-1]) & (p[1:] == p[:-1])], minlength=rows)
                union = np.bincount(pair, minlength=rows) - inter
                yes = pa.array((100 * inter >= percent * union) & (union > 0))
                yield batch.select(["a", "b"]).filter(yes)
            pa.default_memory_pool().release_unused()

    return both.mapInArrow(run, "a long, b long")


def _united(crowded: DataFrame, files: int | None = None) -> DataFrame:
    """``crowded`` (sig, key, key_c, n) with overlapping entries as one, so that their pairs are compared once.

    Entries with the same leading component (most members, then smallest) are united where the
    square of the union is no more than the sum of their squares.
    """
    most = crowded.groupBy("sig", "key_c").agg(F.count(F.lit(1)).alias("m")).groupBy("sig").agg(
        F.max(F.struct("m", (-F.col("key_c")).alias("c"))).alias("top")).select("sig", F.xxhash64("top.c").alias("lead"))
    led = materialise(crowded.join(most, "sig"), "led", files)
    union = led.groupBy("lead", "key", "key_c").agg(F.sum("n").alias("alone"))
    costs = union.groupBy("lead").agg(F.count(F.lit(1)).alias("all"), F.sum("alone").alias("alone"))
    worth = materialise(costs.where(F.col("all").cast("double") * F.col("all") <= F.col("alone")).select("lead", "all"), "united", files)
    one = union.join(worth, "lead").select(F.col("lead").alias("sig"), "key", "key_c", F.col("all").alias("n"))
    return one.union(led.join(worth, "lead", "left_anti").select("sig", "key", "key_c", "n"))


def _chunks(crowded: DataFrame) -> DataFrame:
    """(sig, key, key_c, low, high): the members of an entry in each pair of its chunks of about BLOCK members."""
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    return (crowded.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("sig", "key", "key_c", F.least("chunk", "other").alias("low"),
                    F.greatest("chunk", "other").alias("high")))


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of at least ``width`` buckets as rows of that many; a full count stands for any."""
    rows = []
    for sketch in sketches:
        counts = np.frombuffer(sketch, np.uint8).astype(np.int32)
        counts[counts == 255] = 1 << 24
        rows.append(counts.reshape(-1, width).sum(axis=0))
    return np.array(rows, np.int32).reshape(len(rows), width)


def possible_pairs(size: np.ndarray, sketch: list[bytes], tie: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j, of the members that are not tied and whose sizes and sketches allow to link."""
    order = np.argsort(size, kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    widths = np.array([len(sketch[i]) for i in order])
    for width in np.unique(widths):
        # In order of size, a member's larger partners follow it, up to a bound.
        own = np.flatnonzero(widths == width)
        reach = np.searchsorted(size[order], size[order[own]] * 100 // percent, side="right")
        last = int(reach.max())
        table = _folded([sketch[i] for i in order[own[0]:last]], int(width))
        for at, end in zip(own.tolist(), reach.tolist(), strict=True):
            partner = np.arange(at + 1, end)
            partner = partner[tie[order[partner]] != tie[order[at]]]
            if len(partner):
                most = np.minimum(table[at - own[0]], table[partner - own[0]]).sum(axis=1)
                most = np.minimum(most, size[order[at]])
                yes = partner[100 * most >= percent * (size[order[at]] + size[order[partner]] - most)]
                found.append((np.full(len(yes), order[at]), order[yes]))
    i, j = (np.concatenate(part) for part in zip(*found, strict=True))
    return np.minimum(i, j), np.maximum(i, j)


def _sketched(chunks: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(sig, low, high, a, b): pairs of a chunk pair that may link; a and b are NULL where these are many."""
    def run(table: pa.Table) -> pa.Table:
        names = ("sig", "low", "high", "key", "key_c", "size")
        sig, low, high, key, tie, size = (np.asarray(table.column(c)) for c in names)
        i, j = possible_pairs(size, table.column("sketch").to_pylist(), tie, percent)
        dense = len(i) > PAIRS_EACH * len(key)
        a, b = (pa.nulls(1, pa.int64()),) * 2 if dense else (pa.array(np.minimum(key[i], key[j])),
                                                             pa.array(np.maximum(key[i], key[j])))
        n = len(a)
        return pa.table({"sig": np.repeat(sig[:1], n), "low": np.repeat(low[:1], n), "high": np.repeat(high[:1], n),
                         "a": a, "b": b})

    rows = chunks.join(sketches, "key").select("sig", "low", "high", "key", "key_c", "size", "sketch")
    return rows.groupBy("sig", "low", "high").applyInArrow(run, "sig long, low int, high int, a long, b long")


def _in_blocks(chunks: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) that tie what is similar within chunk pairs, from their (sig, key, key_c, low, high).

    Each pair of chunks is compared in one task; it gives a link per member at most, not its pairs.
    """
    def run(table: pa.Table) -> pa.Table:
        key = np.asarray(table.column("key"))
        tie = np.asarray(table.column("key_c"))
        member, doc = _sets(unpack(table.column("packed").to_pylist()), n)
        size = np.bincount(doc, minlength=len(key))
        _, token, count = np.unique(member, return_inverse=True, return_counts=True)
        often = count[token] > 1
        token = np.unique(token[often], return_inverse=True)[1]
        width = int(token.max()) + 1 if len(token) else 0
        inter = np.zeros((len(key), len(key)), np.float32)
        for low in range(0, width, TOKENS_AT_ONCE):
            here = (token >= low) & (token < low + TOKENS_AT_ONCE)
            has = np.zeros((len(key), min(TOKENS_AT_ONCE, width - low)), np.float32)
            has[doc[often][here], token[here] - low] = 1
            inter += has @ has.T
        union = size[:, None] + size[None, :] - inter
        i, j = np.nonzero((100 * inter >= percent * union) & (union > 0) & (tie[:, None] < tie[None, :]))
        root = labels(len(key), i, j)
        tied = np.flatnonzero(root != np.arange(len(key)))
        return pa.table({"a": key[root[tied]], "b": key[tied]})

    rows = chunks.join(texts, "key").select("sig", "low", "high", "key", "key_c", "packed")
    return rows.groupBy("sig", "low", "high").applyInArrow(run, "a long, b long")


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row; the component is its smallest linked key."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    known = rows.where("key is not null")
    described = materialise(describe(rows, n), "sets")
    parallelism = docs.sparkSession.sparkContext.defaultParallelism
    files = max(parallelism, math.ceil(described.count() / ROWS_A_FILE))

    def written(df: DataFrame, purpose: str) -> DataFrame:
        return materialise(df, purpose, files)

    classes = described.where("size > 0 and key is not null").groupBy("size", "h1", "h2").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    equal = written(described.where("key is not null").join(classes, ["size", "h1", "h2"]).where("key <> first")
                    .select(F.col("first").alias("a"), F.col("key").alias("b")), "equal")

    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = _index_entries(known, frequent_members(known, n), n, percent)
    walked = _walked(entries.repartition(blocks, "sig").sortWithinPartitions("sig", "key"))
    sketches = described.where("key is not null").groupBy("key").agg(
        F.max(F.struct("size", "sketch")).alias("s")).select("key", "s.size", "s.sketch")
    sketches = written(sketches, "sketches")
    sizes = sketches.select("key", "size")
    shared = written(_shared(walked).join(sizes, "key"), "shared")

    def texts_of(keys: DataFrame) -> DataFrame:
        """The texts of some keys."""
        wanted = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key"), "wanted")
        return written(_among(known, wanted, pack=True).join(wanted, "key", "left_semi"), "texts")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("key"))

    def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return written(_linked(pairs, texts, n, percent), "links")

    def with_component(df: DataFrame, found: DataFrame, name: str) -> DataFrame:
        tied = df.join(found.toDF(name, f"{name}_c"), name, "left")
        return tied.withColumn(f"{name}_c", F.coalesce(f"{name}_c", name))

    # The pairs of a key and a leader it meets that may link.
    least_need = F.min(F.least(F.abs("need"), F.abs("leader_need"))).alias("need")
    met = shared.where("key <> leader").groupBy(F.col("leader").alias("a"), F.col("key").alias("b")).agg(
        F.sum("times").alias("n"), least_need, F.max("size").alias("size_b")).where("n >= need")
    met = met.join(sizes.toDF("a", "size_a"), "a").where(_alike("size_a", "size_b", percent))
    met = written(_possible(met.select("a", "b"), sketches, percent), "met")
    texts = texts_of(ends(met))

    # First: every key with the smallest of these leaders.
    first = met.groupBy("b").agg(F.min("a").alias("a"))
    links = equal.union(linked(first.select("a", "b"), texts))
    found = components(links)

    # Then: with every one of them it isn't tied to.
    apart = with_component(with_component(met, found, "a"), found, "b").where("a_c <> b_c").select("a", "b")
    links = links.union(linked(apart, texts))
    found = components(links)

    # Last: every two members of an entry that aren't tied; entries of many components in blocks.
    members = with_component(shared.select("sig", "key", "need", "size", "times"), found, "key")
    # Own members are those whose entry isn't there for counting alone.
    own = F.col("need") > 0
    ties = members.groupBy("sig", "key_c").agg(
        F.count_if(own).alias("own"), F.bit_xor(F.when(own, F.xxhash64("key"))).alias("keys"))
    several = ties.groupBy("sig").agg(
        F.count(F.lit(1)).alias("parts"), F.count_if(F.col("own") > 0).alias("own_parts"), F.sum("own").alias("n"),
        F.bit_xor("keys").alias("keys")).where("parts > 1")
    several = written(several, "several")
    members = written(members.join(several.select("sig", "parts", "own_parts", "n"), "sig"), "loose")
    in_crowds = members.where(F.col("parts") > CROWD)
    # Entries of few components give pairs, which are counted; what a key has in crowds may be missing.
    uncounted = in_crowds.groupBy("key").agg(F.sum("times").alias("uncounted"))
    few = members.where(F.col("parts") <= CROWD).join(uncounted, "key", "left").withColumn(
        "need", F.greatest(F.lit(1), F.abs("need") - F.coalesce("uncounted", F.lit(0))))
    # Two components of an entry meet, and only members of different ones are paired.
    parts = few.groupBy("sig", "key_c").agg(F.max("times").alias("times"))
    meet = parts.toDF("sig", "a_c", "times").join(parts.toDF("sig", "b_c", "_").drop("_"), "sig").where("a_c < b_c")
    side = lambda name: few.select("sig", F.col("key_c").alias(f"{name}_c"), F.col("key").alias(name),
                                   F.col("need").alias(f"{name}_need"), F.col("size").alias(f"{name}_size"))
    pairs = (meet.join(side("a"), ["sig", "a_c"]).join(side("b"), ["sig", "b_c"]).where(_alike("a_size", "b_size", percent))
             .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .agg(F.sum("times").alias("n"), F.min(F.least("a_need", "b_need")).alias("need"))
             .where("n >= need").select("a", "b"))
    pairs = written(_possible(pairs, sketches, percent), "pairs")
    # Of entries of many components the own members are compared; the same members once.
    crowds = several.where((F.col("parts") > CROWD) & (F.col("own_parts") > 1)).groupBy("n", "keys").agg(
        F.min("sig").alias("sig")).select("sig")
    crowded = in_crowds.where(own).join(crowds, "sig", "left_semi").select("sig", "key", "key_c", "n")
    chunks = written(_chunks(_united(crowded, files)), "chunks")
    sketched = written(_sketched(chunks, sketches, percent), "sketched")
    dense = chunks.join(sketched.where("a is null").select("sig", "low", "high"), ["sig", "low", "high"], "left_semi")
    pairs = pairs.union(sketched.where("a is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).select("a", "b"))
    texts = texts_of(ends(pairs).union(dense.select("key")))
    links = links.union(linked(pairs, texts)).union(
        written(_in_blocks(dense, texts, n, percent), "links"))
    found = components(links).toDF("id", "component")
    return described.join(found, F.col("key") == F.col("id"), "left").select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"),
        F.coalesce("component", "key").alias("component_id"))

"""Alignment of two tokenizers by lockstep merging, and how often their tokens meet (operator 11).

Both token sequences of a text cover the same bytes. All texts of a slice are merged at once:
a state vector holds a pointer into A and one into B for every lane, and each step links the two
tokens that a lane points at, moves on the pointer whose token ends first (both at a common
end, which is a cut), and drops finished lanes. A lane is a document, or a stretch of
``LANE`` tokens of a longer one, whose B pointer starts at the first token that reaches into it;
so one long text doesn't hold the others up.

Documents are handled in blocks of about ``BLOCK_BYTES``. A block keeps, compressed, which of its
distinct id pairs each document holds how often, and gives every pair with its number of documents
to Spark, which adds them up over the corpus and returns to each block the counts of its own
pairs. So no table of pairs has to fit anywhere, and texts are encoded once.

Defined cases: null and empty texts, and texts whose tokens do not spell out the space and the
text, have no tokens: zeros, and an empty digest. Each row is a document, also where rows
repeat a key or a key is null. Pairs of equal count are all best. Empty tables give no rows; other columns are
not read. A text of any length is aligned whole, in a block of its own if it is long.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tideline.llm.bpe import token_bytes
from tideline.llm.flat import slices, spread, text_buffers, worker_cache
from tideline.session import materialise

LANE = 256               # A tokens that a lane merges at most
BLOCK_BYTES = 4 << 20    # of text in a block
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_SPACE = "▁"        # stands for a space in the pieces of B
_NEXT, _SWITCH, _GROUP, _END = range(4)
_MARKS = [",", "|", ";", ""]


class Tokenizers:
    """Encoders A (byte-level BPE file) and B (piece model file), and the bytes of their ids."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        tokens = token_bytes(path_a)
        with open(path_a, encoding="utf-8") as file:
            special = {t["id"] for t in json.load(file)["added_tokens"]}
        # Ids of a byte-level vocabulary are in order of merging, as ranks are.
        ranks = {token: number for number, token in enumerate(tokens) if number not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = tokens
        self.bytes_b = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in s], np.int64) for s in (self.bytes_a, self.bytes_b))

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode()

    @cached_property
    def written(self) -> list[str]:
        """Decimal ids, each followed by one of the marks: entry ``4 * id + mark``."""
        return [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in _MARKS]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, or None where either does not spell out the space and the text."""
        if not text:
            return None
        whole = " " + text
        spelled = whole.encode()
        a, b = self.a.encode_to_numpy(whole), self.b.encode(text, num_threads=1)
        if (b"".join(map(self.bytes_a.__getitem__, a.tolist())) != spelled
                or b"".join(map(self.bytes_b.__getitem__, b)) != spelled):
            return None
        return a.astype(np.int64), np.array(b, dtype=np.int64)


def merge(end_a: np.ndarray, end_b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(A and B of each link, A and B of each cut) of two sequences that cover the same bytes.

    ``end_a`` and ``end_b`` are the byte ends of the tokens of texts one after another, and ``starts``
    the first A token of each text. Links come in no particular order, cuts in order.
    """
    sizes = np.diff(np.append(starts, len(end_a)))
    lanes = -(-sizes // LANE)
    at_a = np.repeat(starts, lanes) + LANE * spread(lanes)
    stop = np.minimum(at_a + LANE, np.repeat(starts + sizes, lanes))
    begin = np.concatenate([[0], end_a])[at_a]
    at_b = np.searchsorted(end_b, begin, side="right")
    links_a, links_b, cuts_a, cuts_b = [at_a[:0]], [at_a[:0]], [at_a[:0]], [at_a[:0]]
    while len(at_a):
        links_a.append(at_a)
        links_b.append(at_b)
        a, b = end_a[at_a], end_b[at_b]
        cut = a == b
        cuts_a.append(at_a[cut])
        cuts_b.append(at_b[cut])
        at_a, at_b = at_a + (a <= b), at_b + (b <= a)
        going = at_a < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    return (np.concatenate(links_a), np.concatenate(links_b),
            np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b)))


def _written_groups(ids_a, ids_b, cuts_a, cuts_b, last_a, last_b) -> tuple[np.ndarray, np.ndarray]:
    """(codes into ``written`` of all tokens, group by group; where each text ends in them)."""
    in_a, in_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    mark_a, mark_b = np.full(len(ids_a), _NEXT), np.full(len(ids_b), _NEXT)
    mark_a[cuts_a], mark_b[cuts_b], mark_b[last_b] = _SWITCH, _GROUP, _END
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    before = np.concatenate([[0], cuts_b[:-1] + 1]) if len(cuts_b) else cuts_b
    codes[np.arange(len(ids_a)) + np.repeat(before, in_a)] = 4 * ids_a + mark_a
    codes[np.arange(len(ids_b)) + np.repeat(cuts_a + 1, in_b)] = 4 * ids_b + mark_b
    return codes, last_a + last_b + 2


@dataclass
class Aligned:
    """A slice of texts: figures and digest of each; (document, pair, times) of what is linked."""

    figures: np.ndarray
    digests: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align_texts(tokenizers: Tokenizers, texts: list[str]) -> Aligned:
    encoded = [tokenizers.encode(t) for t in texts]
    some = [i for i, e in enumerate(encoded) if e is not None]
    figures, digests = np.zeros((len(FIGURES), len(texts)), np.int64), [""] * len(texts)
    none = np.zeros(0, np.int64)
    if not some:
        return Aligned(figures, digests, none, none, none)
    ids_a, ids_b = (np.concatenate([encoded[i][k] for i in some]) for k in (0, 1))
    n_a, n_b = (np.array([len(encoded[i][k]) for i in some]) for k in (0, 1))
    last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
    end_a, end_b = np.cumsum(tokenizers.size_a[ids_a]), np.cumsum(tokenizers.size_b[ids_b])
    at_a, at_b, cuts_a, cuts_b = merge(end_a, end_b, last_a + 1 - n_a)
    codes, ends = _written_groups(ids_a, ids_b, cuts_a, cuts_b, last_a, last_b)
    written, begin = list(map(tokenizers.written.__getitem__, codes.tolist())), 0
    for i, end in zip(some, ends.tolist(), strict=True):
        digests[i] = hashlib.sha256("".join(written[begin:end]).encode()).hexdigest()
        begin = end
    doc = np.searchsorted(last_a, at_a)
    groups = np.diff(np.searchsorted(cuts_a, last_a, side="right"), prepend=0)
    figures[:, some] = [n_a, n_b, groups, np.bincount(doc, minlength=len(some))]
    n_pairs = len(tokenizers.bytes_a) * len(tokenizers.bytes_b)
    code, times = np.unique(doc * n_pairs + ids_a[at_a] * len(tokenizers.bytes_b) + ids_b[at_b], return_counts=True)
    return Aligned(figures, digests, np.array(some)[code // n_pairs], code % n_pairs, times)


def _pressed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(np.int32).tobytes())


def _expanded(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


def _steps(place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ascending places of each document as differences; a document's first stays."""
    steps = np.diff(place, prepend=0)
    steps[first] = place[first]
    return steps


def _places(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.cumsum(steps, dtype=np.int64)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    return sums - np.repeat(sums[first] - steps[first], sizes[sizes > 0])


def blocks(docs: DataFrame, path_a: str, pattern: str, path_b: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """A row per block of documents: their keys, figures and digests; the block's distinct pairs with
    their numbers of documents; and (compressed) the pairs of each document.

    The paths name the vocabulary files on every executor.
    """
    numbers, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("keys", T.ArrayType(docs.schema[key].dataType)), *[T.StructField(f, numbers) for f in FIGURES],
        T.StructField("digests", T.ArrayType(T.StringType())), T.StructField("pairs", numbers),
        T.StructField("docs", ints), T.StructField("sizes", ints), T.StructField("steps", T.BinaryType()),
        T.StructField("times", T.BinaryType())])

    def row(keys: pa.Array, parts: list[Aligned]) -> pa.RecordBatch:
        figures = np.concatenate([p.figures for p in parts], axis=1)
        before = np.cumsum([0] + [p.figures.shape[1] for p in parts])
        doc = np.concatenate([p.doc + b for p, b in zip(parts, before, strict=False)])
        pairs, place, held = np.unique(np.concatenate([p.pair for p in parts]), return_inverse=True, return_counts=True)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        sizes = np.bincount(doc, minlength=len(keys))
        lists = [keys, *[pa.array(f) for f in figures], pa.array([d for p in parts for d in p.digests], pa.string()),
                 pa.array(pairs), pa.array(held, pa.int32()), pa.array(sizes, pa.int32())]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists]
        pressed = [pa.array([_pressed(v)], pa.binary())
                   for v in (_steps(place, first), np.concatenate([p.times for p in parts]))]
        return pa.RecordBatch.from_arrays(columns + pressed, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache()
        if ("alignment", path_a, path_b) not in kept:
            kept["alignment", path_a, path_b] = Tokenizers(path_a, pattern, path_b)
        tokenizers = kept["alignment", path_a, path_b]
        keys, parts, size = [], [], 0
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets):
                if parts and size + offsets[j] - offsets[i] > BLOCK_BYTES:
                    yield row(pa.concat_arrays(keys), parts)
                    keys, parts, size = [], [], 0
                keys.append(batch.column(0).slice(i, j - i))
                parts.append(align_texts(tokenizers, batch.column(1).slice(i, j - i).to_pylist()))
                size += offsets[j] - offsets[i]
        if parts:
            yield row(pa.concat_arrays(keys), parts)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def pair_counts(table: DataFrame, size_b: int) -> DataFrame:
    """(pair, n_docs, best): documents that hold each pair linked, and whether no pair of its A id has more."""
    summed = table.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.docs").alias("n_docs"))
    # At most as many rows to an A id as B has ids.
    most = F.max("n_docs").over(Window.partitionBy(F.expr(f"pair div {size_b}")))
    return summed.withColumn("best", F.col("n_docs") == most)


def align(docs: DataFrame, path_a: str, pattern: str, path_b: str, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    table = materialise(blocks(docs, path_a, pattern, path_b, key, text).withColumn(
        "block", F.monotonically_increasing_id()), "alignment-blocks")
    asked = table.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    found = asked.join(pair_counts(table, size_b), "pair").select("of", "place", "n_docs", "best")
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        *[T.StructField(c, T.LongType()) for c in [*FIGURES, "n_best", "count_sum"]],
        T.StructField("groups_sha256", T.StringType())])

    def finish(block: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(counts.column("place")))
        n_docs, best = (np.asarray(counts.column(c))[order] for c in ("n_docs", "best"))
        value = {c: block.column(c).combine_chunks() for c in block.schema.names}
        sizes = np.asarray(value["sizes"].flatten())
        place, times = _places(_expanded(value["steps"][0].as_py()), sizes), _expanded(value["times"][0].as_py())
        ends = np.cumsum(sizes)

        def per_doc(weights: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(weights * times, dtype=np.int64)])
            return sums[ends] - sums[ends - sizes]

        columns = [value["keys"].flatten(), *[value[f].flatten() for f in FIGURES],
                   pa.array(per_doc(best[place].astype(np.int64))), pa.array(per_doc(n_docs[place])),
                   value["digests"].flatten()]
        return pa.Table.from_arrays(columns, schema.names)

    return table.drop("pairs", "docs").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(finish, schema)

"""Cross-tokenizer alignment against the libraries and interval overlaps, document by document."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tideline.llm import alignment
from tideline.llm.bpe import token_bytes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def one_text(libraries, text):
    """(A ids, B ids, groups as text, links as id pairs with repeats) of a text; None without tokens."""
    if not text:
        return None
    a, b = libraries
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a, table = token_bytes(A), [b.id_to_piece(i) for i in range(b.get_piece_size())]
    tokens_a = [bytes_a[i] for i in ids_a]
    tokens_b = [bytes([int(table[i][3:5], 16)]) if b.is_byte(i) else table[i].replace("▁", " ").encode() for i in ids_b]
    if not b"".join(tokens_a) == b"".join(tokens_b) == (" " + text).encode():
        return None
    at_a, at_b = spans(tokens_a), spans(tokens_b)
    cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups, begin = [], 0
    for cut in cuts:
        of = lambda ids, at: ",".join(str(i) for i, (s, e) in zip(ids, at) if begin <= s and e <= cut)  # noqa: B023,E731
        groups.append(of(ids_a, at_a) + "|" + of(ids_b, at_b))
        begin = cut
    links = [(i, j) for i, (s, e) in zip(ids_a, at_a) for j, (u, v) in zip(ids_b, at_b) if s < v and u < e]
    return len(ids_a), len(ids_b), groups, links


def brute_force(libraries, rows):
    each = [(i, one_text(libraries, t)) for i, t in rows]
    counts = Counter(p for _, f in each if f for p in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for i, found in each:
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        best = sum(counts[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


def aligned(docs):
    rows = alignment.align(docs, A, public_tokenizers.PATTERN, B).collect()
    return [(r["doc_id"], *[r[c] for c in COLUMNS]) for r in rows]


ODD = [None, "", " ", "  ", "a", "a  b", "\n", "x\n\n\ty", "Straße naïve", "日本語のテキスト", "emoji 🙂🙂 – “q”", "▁a ▁▁",
       "<|endoftext|> <s></s><unk><0x41>", "\x00\x01", "a" * 700, " " * 300, "?!" * 200, "don't we'll I'd",
       "1234567 89", "é́ combining", "ﬁ ﬂ"]


def order(rows):
    return sorted(rows, key=str)


def test_alignment_equals_brute_force(documents, libraries, prose, monkeypatch):
    monkeypatch.setattr(alignment, "LANE", 7)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    rows = list(enumerate(ODD + [t for t in prose if t is None or len(t) < 900]))
    rows += [(5, "a  b"), (None, "one one"), (None, "one one")]
    assert order(aligned(documents(rows))) == order(brute_force(libraries, rows))


def test_long_text_among_short_ones(documents, libraries):
    text = "The quick naïve fox, over 12 lazy dogs. " * 400
    rows = [(1, text), (2, "dogs."), (3, "")]
    got = {r[0]: r for r in aligned(documents(rows))}
    a, b = libraries
    assert got[1][1:3] == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))
    # The text is one short text over and over, without tokens across.
    once = brute_force(libraries, [(0, text[:41 * 10])])[0]
    assert got[1][1] / once[1] == pytest.approx(40, rel=0.05) and got[1][3] / once[3] == pytest.approx(40, rel=0.05)


def test_empty_table(documents):
    assert aligned(documents([(1, "x")]).where("doc_id = 2")) == []


def test_merge_of_lanes(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 60, 30)
    ends = [], []
    base, starts = 0, []
    for size in sizes.tolist():
        starts.append(len(ends[0]))
        for side in ends:
            inner = np.sort(rng.choice(np.arange(1, size + 1), rng.integers(1, size + 1), replace=False))
            side.extend((base + np.unique(np.append(inner, size))).tolist())
        base += size
    a, b = map(np.array, ends)
    begin_a, begin_b = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
    wanted = {(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]}
    for lane in (1, 3, 1000):
        monkeypatch.setattr(alignment, "LANE", lane)
        at_a, at_b, cuts_a, cuts_b = alignment.merge(a, b, np.array(starts))
        assert len(at_a) == len(wanted) and set(zip(at_a.tolist(), at_b.tolist())) == wanted
        assert a[cuts_a].tolist() == b[cuts_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_encoders_agree_with_the_vocabulary_file(libraries):
    tokenizers = alignment.Tokenizers(A, public_tokenizers.PATTERN, B)
    for text in ODD:
        if text:
            assert tokenizers.a.encode_ordinary(" " + text) == libraries[0].encode(
                " " + text, add_special_tokens=False).ids

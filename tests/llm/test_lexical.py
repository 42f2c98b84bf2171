"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tideline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    holding = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, counts in held:
            m, score = 100 - 50 + (50 * sum(counts.values()) * total) // length, 0
            for t in wanted & counts.keys():
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1)))
                score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score:
                scored.append((-score, math.inf if i is None else i))
        out += [(item, rank, None if i == math.inf else i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, k):
    rows = lexical.search(docs, items, k).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id BIGINT, text STRING, rank STRING, score INT, key INT")


def corpus():
    rng = random.Random(11)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    texts = []
    for _ in range(900):
        words = [rng.choice(common) for _ in range(rng.randint(0, 40))] + [rng.choice(rare) for _ in range(rng.randint(0, 4))]
        rng.shuffle(words)
        texts.append(rng.choice([" ", "-", ", "]).join(words))
    texts += texts[:30] + [None, "", " .,!", "C1 C1 c1", "Ünï Straße ünï", "c1\x00c2", " ".join(common * 700)]
    rng.shuffle(texts)
    return texts


def queries(rng):
    asked = [(i, " ".join([f"c{rng.randrange(12)}" for _ in range(5)] + [f"r{rng.randrange(400)}" for _ in range(5)]),
              None, 1, 2) for i in range(25)]
    return asked + [(30, None, None, 1, 2), (31, "", None, 1, 2), (32, "absent words", None, 1, 2),
                    (33, "Ünï C1/c2", None, 1, 2), (33, "r7", None, 1, 2), (None, "c3 r9", None, 1, 2),
                    (34, " ".join(f"c{i}" for i in range(12)), None, 1, 2)]


@pytest.mark.parametrize("block,visit,long", [(64, 16, 8), (4, 2, 2), (7, 1, 10_000)])
def test_search_equals_scoring_every_document(documents, items, monkeypatch, spark, block, visit, long):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "VISIT", visit)
    monkeypatch.setattr(lexical, "LONG", long)
    docs = [*enumerate(corpus()), (None, "c1 r5"), (3, "c1 c2 r7"), (3, "c1 c2 r7")]
    asked = queries(random.Random(4))
    assert found(documents(docs), items(asked), 10) == brute_force(docs, [a[:2] for a in asked], 10)


def test_search_in_several_passes(documents, items, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_AT_ONCE", 20)
    docs, asked = list(enumerate(corpus()))[:200], queries(random.Random(5))[:12]
    assert found(documents(docs), items(asked), 50) == brute_force(docs, [a[:2] for a in asked], 50)


def test_empty_tables(documents, items):
    some, none = documents([(1, "x y")]), documents([(1, "x y")]).where("doc_id = 2")
    assert found(none, items([(1, "x", None, 1, 2)]), 5) == []
    assert found(some, items([(1, "x", None, 1, 2)]).where("item_id = 2"), 5) == []
    assert found(some, items([(1, None, None, 1, 2)]), 5) == []


def test_blocks_that_cannot_win_are_skipped():
    n = 64 * 100
    rng = np.random.default_rng(0)
    sizes = np.ones(n, np.int64)
    count = np.where(np.arange(n) < 640, 30, rng.integers(1, 3, n))
    lists = lexical.invert(np.full(n, 10), sizes, np.zeros(n, np.int64), count, np.array([500]), n, 10 * n)
    best = lexical.Best(5)
    skipped = lexical.search_piece(lists, np.arange(n), np.array([0]), best, {})
    assert skipped >= 80
    order = np.lexsort((lists.doc, -lists.impact))[:5]
    assert best.key.tolist() == lists.doc[order].tolist()

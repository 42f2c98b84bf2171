"""Words, substring dedup, Jaccard join and components against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import flat, jaccard, substring
from tideline.llm.components import components
from tideline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_of_texts_side_by_side():
    texts = [b"ab cd", b"", b"cd", b" x\ty\x0bz ", "é è".encode()]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    w = flat.words(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(w.start, w.end)] == [x for t in texts for x in t.split()]
    assert w.doc.tolist() == [0, 0, 2, 3, 3, 3, 4, 4]
    assert w.hash[1] == w.hash[2] and len(set(w.hash.tolist())) == 7


def removed(rows, window=20):
    """doc_id -> (words, removed words, kept text), windows judged on the input in order of (doc_id, start)."""
    first, out = {}, {}
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for i, text in known:
        words = WORD.findall(text or "")
        for a in range(len(words) - window + 1):
            first.setdefault(tuple(words[a:a + window]), (i, a))
    for i, text in known:
        words = WORD.findall(text or "")
        gone = set()
        for a in range(len(words) - window + 1):
            if first[tuple(words[a:a + window])] < (i, a):
                gone.update(range(a, a + window))
        out[i] = (len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone))
    return out


def test_substring_dedup_equals_brute_force(documents, prose):
    rows = list(enumerate(prose))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
           for r in substring.remove_repeats(documents(rows)).collect()}
    assert got == removed(rows)


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)


def test_runs_that_cross_batches(documents, prose, small_batches):
    """Runs of equal entries go on from batch to batch; nothing is lost at the seams."""
    rows = list(enumerate(prose[:40]))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
           for r in substring.remove_repeats(documents(rows)).collect()}
    assert got == removed(rows)
    near = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar(documents(rows)).collect()}
    assert near == grouped(rows)


def test_factors_name_their_source(documents, prose):
    rows = dict(enumerate(prose))
    for r in substring.remove_repeats(documents(prose)).where("n_removed > 0").collect():
        words = WORD.findall(rows[r["doc_id"]])
        for f in r["factors"]:
            source = WORD.findall(rows[f["ref_key"]])
            assert f["length"] >= 20 and (f["ref_key"], f["ref_start"]) < (r["doc_id"], f["start"])
            assert (words[f["start"]:f["start"] + f["length"]]
                    == source[f["ref_start"]:f["ref_start"] + f["length"]])


def test_substring_dedup_of_odd_rows(documents):
    long = " ".join(f"x{i}" for i in range(30))
    got = substring.remove_repeats(documents([(None, long), (5, long), (5, long), (6, long)]), carry=["lang", "key"])
    assert sorted((r["doc_id"] or -1, r["n_removed"], r["lang"], r["key"]) for r in got.collect()) == [
        (-1, 0, "en", "k"), (5, 0, "en", "k"), (5, 0, "en", "k"), (6, 30, "en", "k")]
    assert substring.remove_repeats(documents([])).count() == 0


def sets(rows, n=5):
    out = {}
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        out[i] = {tuple(words[a:a + n]) for a in range(len(words) - n + 1)} if len(words) >= n else (
            {tuple(words)} if words else set())
    return out


def grouped(rows):
    """doc_id -> (set size, smallest doc_id reachable by links)."""
    found = sets(rows)
    group = {i: i for i in found}
    changed = True
    while changed:
        changed = False
        for a in found:
            for b in found:
                inter = len(found[a] & found[b])
                if found[a] and 100 * inter >= 75 * (len(found[a]) + len(found[b]) - inter) and group[a] < group[b]:
                    group[b], changed = group[a], True
    return {i: (len(s), group[i]) for i, s in found.items()}


def test_jaccard_join_equals_brute_force(documents, prose):
    rows = list(enumerate(prose))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar(documents(rows)).collect()}
    assert got == grouped(rows)
    assert len({c for _, c in got.values()}) < len(got) - 20


def test_jaccard_join_of_a_chain_and_a_star(documents):
    """Near copies that are not near each other, tied through one text or step by step."""
    base = [f"b{i}" for i in range(200)]
    star = []
    for k in range(8):
        words = list(base)
        for j in range(4):
            words[k * 24 + j * 6] = f"s{k}.{j}"
        star.append(" ".join(words))
    chain, words = [], [f"c{i}" for i in range(100)]
    for k in range(6):
        words = words[6:] + [f"d{k}.{i}" for i in range(6)]
        chain.append(" ".join(words))
    rows = list(enumerate([*star, " ".join(base), *chain]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar(documents(rows)).collect()}
    assert got == grouped(rows)
    assert {got[i][1] for i in range(9)} == {0} and {got[i][1] for i in range(9, 15)} == {9}


def test_crowded_entries_are_compared_in_blocks(documents, monkeypatch):
    """Many texts that share an index entry, few of which link; in blocks and pair by pair."""
    import random
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 6])):
            words[rng.randrange(80)] = f"x{rng.randrange(30)}"
        rows.append((k, " ".join(words)))
    want = grouped(rows)
    assert 4 < len({c for _, c in want.values()}) < 50
    for crowd, block, pairs in ((1, 8, 0), (1, 8, 1000), (1000, 384, 4)):
        monkeypatch.setattr(jaccard, "CROWD", crowd)
        monkeypatch.setattr(jaccard, "PAIRS_EACH", pairs)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar(documents(rows)).collect()}
        assert got == want


def test_entries_of_the_same_keys_are_one(spark, monkeypatch):
    """Whatever batches and rows an entry is spread over."""
    monkeypatch.setattr(jaccard, "ROW_KEYS", 4)
    entries = {1: [1, 2], 2: [1, 2], 3: [7], 4: [1, 2, 3], 5: list(range(20, 33)), 6: [1, 2], 7: [5, 6, 7, 8], 8: [5, 6, 7, 8, 9]}
    rows = [(sig, key, 1) for sig, keys in entries.items() for key in keys for _ in range(1 + key % 2)]
    df = spark.createDataFrame(rows, "sig long, key long, need int").coalesce(1).sortWithinPartitions("sig", "key")
    want = sorted([(1, [1, 2], 3), (1, [1, 2, 3], 1), (5, [5, 6, 7, 8], 1), (5, [5, 6, 7, 8, 9], 1), (20, list(range(20, 33)), 1)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "3", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = jaccard._shared(jaccard._walked(df)).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        got = {}
        for r in found:
            got.setdefault((r["sig"], r["leader"], r["times"]), []).append(r["key"])
        assert sorted((leader, sorted(keys), times) for (_, leader, times), keys in got.items()) == want


def test_overlapping_crowds_are_compared_once(spark):
    """A hundred entries of nearly the same keys give no more rows than one; entries apart stay apart."""
    rows = [(sig, key, key, 190) for sig in range(100) for key in range(200) if (sig + key) % 20]
    rows += [(sig, key, key, 30) for sig in (500, 501) for key in [0, *range(sig * 100, sig * 100 + 29)]]
    united = jaccard._united(spark.createDataFrame(rows, "sig long, key long, key_c long, n long")).collect()
    together = {}
    for r in united:
        together.setdefault(r["sig"], set()).add(r["key"])
    assert len(united) < 1000
    assert all(any(set(range(200)) - {k for k in range(200) if not (sig + k) % 20} <= keys for keys in together.values())
               for sig in range(100))
    assert all(any({0, *range(sig * 100, sig * 100 + 29)} <= keys for keys in together.values()) for sig in (500, 501))


def test_texts_that_nobody_asks_for_stay_out(spark):
    rows = spark.range(3000).selectExpr("id AS key", "concat('t', id) AS text")
    got = {r["key"]: r["text"] for r in jaccard._among(rows, rows.where("key % 10 = 3").select("key")).collect()}
    assert {k: f"t{k}" for k in range(3, 3000, 10)}.items() <= got.items() and len(got) < 310


def test_jaccard_join_of_odd_rows(documents):
    text = "a b c d e f g"
    got = jaccard.similar(documents([(None, text), (3, text), (3, text), (9, text.upper()), (4, None)]))
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in got.collect()) == [
        (-1, 3, None), (3, 3, 3), (3, 3, 3), (4, 0, 4), (9, 3, 3)]
    assert jaccard.similar(documents([])).count() == 0


@pytest.mark.parametrize("frequent_share", [0.0, 0.5, 1.0])
def test_similar_sets_always_share_a_signature(frequent_share):
    """The pigeonhole holds for sets of all sizes, at the very threshold, whatever is frequent."""
    rng = np.random.default_rng(7)
    for size in [*range(1, 40), 63, 64, 65, 150, 255, 256, 300, 700]:
        for _ in range(12):
            x = rng.integers(0, 2**63, size, dtype=np.uint64)
            # Largest change allowed: drop d and add a with 100 * (size - d) >= 75 * (size + a).
            drop = int(rng.integers(0, size // 4 + 1))
            add = int((100 * (size - drop)) // 75 - size)
            if add < 0:
                continue
            y = np.concatenate([x[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)])
            frequent = np.sort(x[: int(size * frequent_share)])
            member = np.concatenate([x, y])
            doc = np.repeat([0, 1], [len(x), len(y)])
            sig, of = jaccard.signatures(member, doc, np.array([len(x), len(y)]), frequent)
            assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist()), (size, drop, add)


def test_sets_crowded_into_few_segments_fall_back_to_single_members():
    rng = np.random.default_rng(1)
    many = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    salt = flat.mix(np.array([1 + 77], np.uint64))
    crowded = many[flat.mix(many ^ salt) % np.uint64(11) == 0][:16]
    for drop in range(12):
        x, y = np.delete(crowded[:12], drop), crowded[:12]
        sig, of = jaccard.signatures(np.concatenate([x, y]), np.repeat([0, 1], [11, 12]), np.array([11, 12]),
                                     np.zeros(0, np.uint64))
        assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())


def test_components(spark):
    rng = np.random.default_rng(0)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    loose = [tuple(map(int, rng.integers(2000, 2100, 2))) for _ in range(60)]
    links = path + star + loose + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_queries_give_the_digest_of_the_kept_text(spark):
    got = QUERIES["op1_substring_dedup"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = removed([(r["doc_id"], r["text"]) for r in docs])
    for r in got.collect():
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    near = QUERIES["op9_jaccard_join"](spark, "/root/testdata/sf0.001")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.collect()} == grouped(
        [(r["doc_id"], r["text"]) for r in docs])
    assert got.select(F.sum("n_removed")).first()[0] > 0


@pytest.mark.parametrize("extra", [0.0, 0.3])
def test_linked_sets_have_the_common_entries_they_ask_for(monkeypatch, extra):
    monkeypatch.setattr(jaccard, "EXTRA", extra)
    rng = np.random.default_rng(12)
    for size in [*range(1, 40), 60, 150, 700]:
        for _ in range(6):
            x = rng.integers(0, 2**63, size).astype(np.uint64)
            gone, fresh = rng.integers(0, max(1, size // 6) + 1, 2)
            y = np.concatenate([x[gone:], rng.integers(0, 2**63, fresh).astype(np.uint64)])
            if not len(y) or 100 * (size - gone) < 75 * (size + fresh):
                continue
            member, doc = np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)])
            frequent = np.sort(rng.choice(x, size // 2, replace=False))
            sig, of, need = jaccard.entries_of(member, doc, np.array([len(x), len(y)]), frequent)
            common = np.intersect1d(sig[of == 0], sig[of == 1])
            asked = [abs(int(n)) for s, n in zip(sig, need) if s in common]
            assert asked and len(common) >= min(asked)
            assert np.intersect1d(sig[(of == 0) & (need > 0)], sig[(of == 1) & (need > 0)]).size


def test_a_group_of_near_copies_and_a_stranger_in_its_entries(documents, spark):
    """Texts with a long passage in common: many near copies, and one that only shares the passage."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(60))
    body = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(1500):
        own = list(body)
        own[i % 120] = f"changed{i}"
        texts.append(f"{passage} {' '.join(own)}")
    texts.append(passage + " " + " ".join(f"s{i}" for i in rng.integers(0, 10**6, 40)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar(documents(texts)).collect()}
    assert {got[i] for i in range(1500)} == {0} and got[1500] == 1500


def test_sketches_exclude_no_link():
    rng = np.random.default_rng(3)
    sets = []
    for size in [1, 2, 3, 5, 9, 17, 40, 64, 100, 700, 5000]:
        x = rng.integers(0, 2**63, size).astype(np.uint64)
        for gone in (0, size // 8, size // 4):
            sets.append(x[gone:])
            sets.append(np.concatenate([x[gone:], rng.integers(0, 2**63, size // 16).astype(np.uint64)]))
    size, sketch = np.array([len(s) for s in sets]), [jaccard._sketch(s) for s in sets]
    i, j = jaccard.possible_pairs(size, sketch, np.arange(len(sets)), 75)
    found = set(zip(i.tolist(), j.tolist()))
    linked = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert linked <= found and len(found) < len(linked) * 2.5

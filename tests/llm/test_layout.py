"""Sharding, chat formatting and packing."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tideline.llm import chat, packing, sharding
from tideline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, segment STRING, position INT"


def by_hand(rows, shards, seed=0):
    """Rows (doc_id, source, text) with their (shard, slot)."""
    import hashlib
    of_source = defaultdict(list)
    for i, source, text in rows:
        h = hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        of_source[source].append((h, i if i is not None else -1, zlib.crc32((text or "").encode()), i))
    order = []
    for source, members in of_source.items():
        for rank, member in enumerate(sorted(members), start=1):
            order.append(((rank - 0.5) / len(members), source is not None, source or "", rank, member[3]))
    order.sort()
    n = len(order)
    return Counter((r[4], p * shards // n, p - -(-(p * shards // n) * n // shards)) for p, r in enumerate(order))


def test_sharding_equals_brute_force(documents):
    rows = [(i, ["a", "a", "b", None][i % 4], None if i % 9 == 0 else "é" * (i % 5)) for i in range(97)]
    rows += [(3, "a", "same key"), (3, "a", "same key"), (None, "b", "no key")]
    docs = documents([(i, t) for i, _, t in rows]).drop("source")
    docs = docs.sparkSession.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING").withColumn("shard", F.lit("x"))
    got = sharding.interleave(docs, 7).collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in got) == by_hand(rows, 7)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    assert Counter((r["size"], r["text_crc32"]) for r in got) == Counter(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, _, t in rows)


def test_every_shard_has_the_mixture(spark):
    got = QUERIES["op3_sharding"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    n, of_source = len(got), Counter(r["source"] for r in got)
    for (shard, source), count in Counter((r["shard"], r["source"]) for r in got).items():
        assert abs(count - of_source[source] / 40) < 2
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert n == 1000 and all(sorted(s) == list(range(25)) for s in slots.values()) and len(slots) == 40


def test_fewer_rows_than_shards_and_none(documents):
    got = sharding.interleave(documents(["a", "b", None]), 40).collect()
    assert len({r["shard"] for r in got}) == 3 and {r["slot"] for r in got} == {0}
    assert sharding.interleave(documents([]), 40).count() == 0


def in_sql(conversations):
    frame = conversations.select("conv_id", "turn", "role", "text").toPandas()  # noqa: F841
    return Counter(tuple(r) for r in duckdb.sql(
        ORACLES["op4_chat_rotation"].replace("FROM conversations", "FROM frame")).fetchall())


@pytest.fixture
def turns(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", ""), (1, 4, None, "who?"),
            (2, 0, "system", "alone"), (3, 1, "bob", "x" * 5000), (3, 1, "bob", "twice"), (3, 1, "bob", "twice"),
            (3, 1, "ann", "tie"), (3, None, "ann", "no turn"), (None, 1, "cat", "no id"), (None, 2, "dog", "é")]
    rows += [(4, i, ["p", "q", "r", "s"][i % 4], f"line {i}") for i in range(300)]
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], TURNS)


def test_rotation_equals_sql(turns):
    got = chat.rotate(turns)
    assert Counter(tuple(r) for r in got.collect()) == in_sql(turns)
    assert {r["conv_id"] for r in got.collect()} == {1, 3, 4, None}


def test_segments_join_to_the_dialogue_and_targets_are_the_own_words(turns):
    renders = defaultdict(list)
    for r in chat.rotate(turns).where("conv_id in (1, 4)").collect():
        renders[r["conv_id"], r["perspective"]].append(r)
    assert len(renders) == 3 + 4
    for (_, who), rows in renders.items():
        rows.sort(key=lambda r: r["position"])
        whole = "".join(r["segment"] for r in rows)
        assert [r["position"] for r in rows] == list(range(len(rows)))
        for r in rows:
            assert whole[r["begin"]:r["end"]] == r["segment"]
            target = whole[r["target_begin"]:r["target_end"]]
            if r["speaker"] == who:
                assert r["segment"] == f"<|assistant|>\n{target}\n<|end|>\n"
            else:
                assert target == "" and r["role"] in ("user", "system")


def test_no_turns(spark):
    assert chat.rotate(spark.createDataFrame([], TURNS)).count() == 0


def packed(docs, capacity=100):
    return packing.pack(docs, capacity, F.octet_length("text"), F.xxhash64("text"))


def test_packing_keeps_its_promises(documents):
    texts = [None, "", "", *["x" * (i % 97) for i in range(400)], "y" * 250, "z" * 300, *["copy"] * 30]
    docs = documents(texts, sources=("a", "b", "c", None, "a", "d"))
    rows = packed(docs).collect()
    facts = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    for i, (text, _) in facts.items():
        assert sum(r["size"] for r in pieces[i]) == len(text or "")
        assert sorted(r["piece"] for r in pieces[i]) == list(range(pieces[i][0]["pieces"])) and len(pieces[i]) == pieces[i][0]["pieces"]
    for members in bins.values():
        members.sort(key=lambda r: r["slot"])
        assert sum(r["size"] for r in members) <= 100
        assert [r["offset"] for r in members] == [sum(x["size"] for x in members[:k]) for k in range(len(members))]
        sources = [s for r in members if (s := facts[r["doc_id"]][1]) is not None]
        texts_in = [t for r in members if (t := facts[r["doc_id"]][0]) is not None]
        assert len(sources) == len(set(sources)) and len(texts_in) == len(set(texts_in))


def test_the_tightest_compatible_bin_is_found():
    import random
    rng = random.Random(5)
    sizes = sorted((rng.randint(0, 60) for _ in range(300)), reverse=True)
    sources = [rng.choice([-1, 0, 0, 1, 2, 3]) for _ in sizes]
    clusters = [rng.choice([-1, -1, *range(30)]) for _ in sizes]
    bins, want = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] >= size and (source < 0 or source not in b[1])
                and (cluster < 0 or cluster not in b[2])]
        number = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([100, set(), set()])
        bins[number][0] -= size
        bins[number][1].add(source)
        bins[number][2].add(cluster)
        want.append(number)
    assert packing.pack_group(sizes, sources, clusters, 100) == (want, len(bins))


def test_packing_of_odd_rows(documents):
    rows = packed(documents([(None, "abc"), (1, "abc"), (1, "abc")])).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == [(-1, 3), (1, 3), (1, 3)]
    assert packed(documents([])).count() == 0


def test_null_and_empty_texts_conflict_with_nothing(spark):
    rows = [(i, None if i % 2 else "", f"s{i}") for i in range(20)] + [(30, "same", "x"), (31, "same", "y")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    got = {r["doc_id"]: r["bin_id"] for r in packing.pack(
        docs, 100, F.octet_length("text"), packing.copies("text")).collect()}
    assert len({got[i] for i in range(20)}) == 1 and got[30] != got[31]


def test_a_row_repeated_very_often_is_dealt_to_all_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 100)
    docs = spark.createDataFrame([(7, "again", "s")] * 900 + [(i, f"t{i}", "s") for i in range(1000, 1100)],
                                 "doc_id BIGINT, text STRING, source STRING")
    got = packing.pack(docs, 100, F.octet_length("text"), packing.copies("text")).collect()
    assert len(got) == 1000 and len({r["bin_id"] for r in got if r["doc_id"] == 7}) == 900
    groups = [r["bin_id"] >> 32 for r in got if r["doc_id"] == 7]
    assert max(groups.count(g) for g in set(groups)) < 200

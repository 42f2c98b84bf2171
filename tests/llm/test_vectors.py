"""Embedding near-dedup and nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import embedding_dedup, neighbours

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, key STRING, rows STRING"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for group in range(6):
        base = rng.normal(size=24)
        for _ in range(12):
            x = base + rng.normal(size=24) * rng.choice([0.0, 0.02, 0.1, 0.17, 0.3])
            out.append((x * rng.choice([1.0, 3.0])).astype(np.float32).tolist())
    out += [rng.normal(size=24).astype(np.float32).tolist() for _ in range(80)]
    out += [out[0], out[0], out[1], None, [], [0.0] * 24, [1.0, None], [float("nan")] * 24, [float("inf")] + [1.0] * 23,
            [1.0, 2.0], [2.0, 4.0], [1.0, 2.0]]
    out = [(i, v, [1, 1, 2, None][i % 4] if i % 7 else 1, "k", None) for i, v in enumerate(out)]
    return [(i * 5, *r) for i, (_, *r) in enumerate(out)]


def good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_near_duplicates_equal_brute_force(spark, rows):
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    unit = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in rows if good(r[1]) and r[2] is not None}
    label = {r[0]: r[2] for r in rows}
    near = {i: {j for j in unit if j != i and label[i] == label[j] and len(unit[i]) == len(unit[j])
                and unit[i] @ unit[j] >= 0.98} for i in unit}
    group = {r[0]: r[0] for r in rows}
    for _ in range(20):
        for i in near:
            group[i] = min([group[i], *(group[j] for j in near[i])])
    assert got == {r[0]: (len(near.get(r[0], ())), group[r[0]], group[r[0]] == r[0]) for r in rows}
    assert sum(n for n, _, _ in got.values()) > 100


def test_blocks_of_a_bucket_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(9)
    base = rng.normal(size=16)
    vectors = [(i, (base + rng.normal(size=16) * 0.01).astype(np.float32).tolist(), 1, "k", None) for i in range(90)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(89, 0)}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(empty).count() == 0
    assert neighbours.search(empty, F.lit(True)).count() == 0


def nearest(rows, k=10):
    found = [(i, np.array(v, dtype=np.float64)) for i, v in rows if good(v)]
    out = {}
    for i, v in found:
        if i % 10 == 0:
            others = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in found if j != i and len(w) == len(v))
            out[i] = [(j, d) for d, j in others[:k]]
    return out


def test_neighbours_of_a_small_table_are_exact(spark, rows):
    got = {}
    query = F.col("vec_id") % 10 == 0
    for r in neighbours.search(spark.createDataFrame(rows, SCHEMA), query, lists=4, reach=10.0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = {q: dict(enumerate(v, start=1)) for q, v in nearest([r[:2] for r in rows]).items() if v}
    assert got == want


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = {q: {j for j, _ in v} for q, v in nearest(
        [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]).items() if q % 100 == 0}
    got = {}
    for r in neighbours.search(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(want[q] & got[q]) / len(want[q]) for q in want]) >= 0.9


def test_graph_search_reaches_what_the_ratio_asks_for():
    rng = np.random.default_rng(2)
    centroids = rng.normal(size=(128, 16))
    graph = neighbours.CentroidGraph(centroids)
    x = rng.normal(size=(50, 16))
    distance, order = graph.search(x, 1.2)
    true = np.sqrt(((x[:, None] - centroids[None]) ** 2).sum(axis=2))
    found = asked = 0
    for i in range(50):
        wanted = set(np.flatnonzero(true[i] <= 1.2 * true[i].min()).tolist())
        found += len(wanted & set(order[i][distance[i] <= 1.2 * distance[i, 0]].tolist()))
        asked += len(wanted)
    assert found / asked > 0.97


def test_balanced_lists():
    x = np.random.default_rng(0).normal(size=(1000, 8))
    assert len(neighbours.balanced_centroids(x, 64, least=8)) == 64
    assert len(neighbours.balanced_centroids(x[:3], 64)) == 1

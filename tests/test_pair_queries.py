"""Queries over all pairs of users give every pair, on tables of their own rows."""

import datetime
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from test_blocks import brute, pearson
from tideline.operators import blocks, similarity as S

RATINGS = "user_id BIGINT, item_id BIGINT, pref DOUBLE"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
KINDS = ["click", "error", "purchase", "signup", "view"]


@pytest.fixture
def events(spark, tmp_path):
    """Eleven users' events of five kinds at a few hours, and the ratings they come to."""
    rows, prefs = [], {}
    for user, item in itertools.product(range(11), range(9)):
        if (user + item) % 4 == 0:
            continue
        kind, hour = item % 5, item // 5
        value = float((user * 7 + item * item * 3 + user * item) % 13)
        rows.append((len(rows), datetime.datetime(2024, 1, 1 + user, hour), user, KINDS[kind], value, ""))
        prefs[user, kind * 24 + hour] = value
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path), [(user, item, pref) for (user, item), pref in prefs.items()]


def test_pearson_query_returns_every_pair(spark, events):
    folder, ratings = events
    expected = brute(ratings, pearson)
    rows = queries()["c01_pearson"](spark, folder).collect()
    got = {(r.user_id, r.other_user_id): (r.sim, r.n) for r in rows}
    assert len(rows) == len(got) and got.keys() == expected.keys()
    assert all(got[p] == (pytest.approx(sim, abs=1e-6), n) for p, (sim, n) in expected.items())
    for r in rows:
        sims = [sim for (user, _), (sim, _) in expected.items() if user == r.user_id]
        assert r.n_similar == len(sims)
        assert (r.mean_sim, r.min_sim, r.max_sim) == pytest.approx((sum(sims) / len(sims), min(sims), max(sims)), abs=1e-6)


def test_pearson_query_shuffles_no_pair(spark, events):
    plan = queries()["c01_pearson"](spark, events[0])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_threshold_rows_of_a_task_come_by_similarity(spark):
    """Equal similarities stand together where they are written, as the two ways of each pair always are."""
    rng = np.random.default_rng(3)
    ratings = [(u, i, float(rng.normal())) for u in range(300) for i in range(12) if rng.random() < 0.8]
    near = S.neighbours(spark.createDataFrame(ratings, RATINGS), "pearson", min_sim=0.1)
    rows = near.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    expected = {pair: found for pair, found in brute(ratings, pearson).items() if found[0] >= 0.1}
    got = {(r.user_id, r.other_user_id): (r.sim, r.n) for r in rows}
    assert len(rows) == len(got) and got.keys() == expected.keys()
    assert all(got[p] == (pytest.approx(sim, abs=1e-9), n) for p, (sim, n) in expected.items())
    for _, part in itertools.groupby(sorted(rows, key=lambda r: r.at), key=lambda r: r.part):
        sims = [round(r.sim, 9) for r in part]
        assert sims == sorted(sims)


@pytest.mark.parametrize("ordered", [False, True])
def test_rows_handed_on_in_parts_are_all_rows(monkeypatch, ordered):
    order = S._alike_together if ordered else None
    monkeypatch.setattr(blocks, "KEPT_ROWS", 10)
    rng = np.random.default_rng(4)
    rows, whole, got = blocks._Rows(None, order), [], []
    for _ in range(30):
        part = [rng.integers(0, 9, 7), rng.integers(0, 9, 7), rng.uniform(-1, 1, 7).round(1), rng.integers(1, 5, 7)]
        whole += zip(*part)
        rows.add(list(part))
        if rows.full():
            got += [list(zip(*taken)) for taken in rows.take()]
    got += [list(zip(*taken)) for taken in rows.take()] if rows.size else []
    assert max(map(len, got)) <= 10
    assert sorted(itertools.chain(*got)) == sorted(whole)

import math

import pytest

from tideline.operators import recommend
from tideline.operators.recommend import estimate, recommend_items, recommend_users, users
from tideline.operators.similarity import item_similarity, neighbours, user_similarity
from tideline.sinks.text import write_recs


def close(got, expected, tol=1e-5):
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], v, abs_tol=tol) for k, v in expected.items()), got


def pairs(df):
    return {(r.user_id, r.other_user_id): r.sim for r in df.collect() if r.user_id < r.other_user_id}


def recs(df):
    return {(r.user_id, r.rank, r.item_id): r.score for r in df.collect()}


def test_euclidean_golden(small_ratings):
    close(pairs(user_similarity(small_ratings, "euclidean")), {
        (1, 4): 0.738796, (1, 5): 0.607719, (1, 2): 0.305527, (1, 3): 0.285714, (2, 3): 0.406878,
        (2, 5): 0.325028, (2, 4): 0.283036, (3, 5): 0.489996, (3, 4): 0.356789, (4, 5): 0.571429})


def test_nearest_golden(small_ratings):
    rows = neighbours(small_ratings, n=2).orderBy("user_id", "rank").collect()
    found = {}
    for r in rows:
        found.setdefault(r.user_id, []).append(r.other_user_id)
    assert found == {1: [4, 5], 2: [3, 5], 3: [5, 2], 4: [1, 5], 5: [1, 4]}


def test_user_recs_golden(small_ratings):
    close(recs(recommend_users(small_ratings)), {
        (1, 1, 104): 4.274336, (1, 2, 106): 4.0, (2, 1, 105): 4.055916, (3, 1, 103): 3.360988,
        (3, 2, 102): 2.773169, (4, 1, 102): 3.0})


def test_named_users_get_the_same(small_ratings):
    everyone = recs(recommend_users(small_ratings))
    close(recs(recommend_users(small_ratings, users=[1, 3])),
          {k: v for k, v in everyone.items() if k[0] in (1, 3)})


def test_pearson_golden(pearson_ratings):
    close(pairs(user_similarity(pearson_ratings, "pearson")), {
        (1, 2): 0.968036, (1, 3): 0.427008, (1, 4): -0.682211, (2, 3): 0.486299,
        (2, 4): -0.838817, (3, 4): -0.389539})


def test_threshold_golden(pearson_ratings):
    rows = neighbours(pearson_ratings, "pearson", min_sim=0.1).collect()
    assert {(r.user_id, r.other_user_id) for r in rows} == {
        (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)}


def test_one_user_golden(pearson_ratings):
    one = recommend_users(pearson_ratings, 3, "pearson", n=None, min_sim=0.1, users=[2])
    close(recs(one), {(2, 1, 12): 4.832811, (2, 2, 13): 4.665621, (2, 3, 14): 4.331242})
    everyone = recs(recommend_users(pearson_ratings, 3, "pearson", n=None, min_sim=0.1))
    assert {k for k in everyone if k[0] != 2} == {(3, 1, 10)}
    assert math.isclose(everyone[3, 1, 10], 1.0)


def test_single_neighbour_gives_no_estimate(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, 5.0), (2, 2, 4.0)], "user_id BIGINT, item_id BIGINT, pref FLOAT")
    assert estimate(ratings, neighbours(ratings, n=2)).count() == 0


def test_neighbours_wants_one_rule(small_ratings):
    for rule in ({}, {"n": 2, "min_sim": 0.1}):
        with pytest.raises(ValueError):
            neighbours(small_ratings, **rule)


def test_item_similarity_golden(small_ratings):
    got = {(r.item_id, r.other_item_id): r.sim for r in item_similarity(small_ratings).collect()
           if r.item_id < r.other_item_id}
    third, half = 1 / 3, 0.5
    close(got, {
        (101, 102): 0.414214, (101, 103): half, (101, 104): half, (101, 105): 0.366025,
        (101, 106): 0.366025, (101, 107): third, (102, 103): half, (102, 104): 0.366025,
        (102, 105): 0.366025, (102, 106): 0.366025, (103, 104): 0.414214, (103, 105): third,
        (103, 106): 0.414214, (104, 105): 0.414214, (104, 106): 0.414214, (104, 107): 0.366025,
        (105, 106): 0.414214, (105, 107): half})


ITEM_RECS = {
    (1, 1, 104): 1.280239, (1, 2, 106): 1.146264, (1, 3, 105): 1.065384, (1, 4, 107): 0.333333,
    (2, 1, 106): 1.560478, (2, 2, 105): 1.479598, (2, 3, 107): 0.699359, (3, 1, 103): 1.247547,
    (3, 2, 106): 1.194453, (3, 3, 102): 1.146264, (4, 1, 102): 1.646264, (4, 2, 105): 1.527786,
    (4, 3, 107): 0.699359, (5, 1, 107): 1.199359}


def test_item_recs_golden(small_ratings):
    close(recs(recommend_items(small_ratings)), ITEM_RECS)


def test_write_recs(spark, small_ratings, tmp_path):
    write_recs(recommend_items(small_ratings), str(tmp_path / "recs"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "recs")).collect())
    assert len(lines) == 5
    assert lines[0].startswith("1\t[104:1.28023") and lines[0].endswith("]")
    assert [e.split(":")[0] for e in lines[0][3:-1].split(",")] == ["104", "106", "105", "107"]


def test_users(small_ratings):
    assert sorted(r.user_id for r in users(small_ratings).collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("metric", ["pearson", "euclidean"])
def test_repeated_ratings_count_once_in_every_plan(spark, small_ratings, metric):
    again = spark.createDataFrame([(1, 101, 4.0), (1, 101, 3.0), (2, 102, 2.5)], small_ratings.schema)
    ratings = small_ratings.union(again)
    columns = ["user_id", "other_user_id", "n"]
    everyone = user_similarity(ratings, metric)
    named = user_similarity(ratings, metric, users=[1, 2])
    expected = {tuple(r[c] for c in columns): r["sim"] for r in everyone.where("user_id <= 2").collect()}
    got = {tuple(r[c] for c in columns): r["sim"] for r in named.collect()}
    assert got.keys() == expected.keys() and len(got) > 5
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    single = {(r["user_id"], r["other_user_id"]): r["n"] for r in user_similarity(small_ratings, metric).collect()}
    assert all(single[a, b] == n for a, b, n in got)


def test_a_hot_item_is_joined_in_slices(spark, monkeypatch):
    rows = [(u, 1, 1.0) for u in range(600)] + [(u, 2 + u % 40, 1.0) for u in range(1200)]
    seen = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, pref DOUBLE").select("user_id", "item_id")
    similar = item_similarity(spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, pref DOUBLE"), 5)
    whole = {(r["user_id"], r["item_id"]): r["score"] for r in recommend.item_scores(seen, similar).collect()}
    monkeypatch.setattr(recommend, "SLICE_USERS", 50)
    monkeypatch.setattr(recommend, "MOST_HOT", 100)
    assert [tuple(r) for r in recommend.hot_items(seen).collect()] == [(1, 12)]
    parts = recommend.sliced_join(seen, similar).groupBy("item_id", "slice").agg(
        recommend.F.countDistinct("user_id").alias("users")).collect()
    assert len([r for r in parts if r["item_id"] == 1]) == 12
    assert max(r["users"] for r in parts) <= 2 * 50
    assert {(r["user_id"], r["item_id"]): r["score"] for r in recommend.item_scores(seen, similar).collect()} == whole


def test_hot_items_are_few(spark, monkeypatch):
    seen = spark.range(5000).selectExpr("id user_id", "id % 100 item_id")
    monkeypatch.setattr(recommend, "SLICE_USERS", 1)
    monkeypatch.setattr(recommend, "MOST_HOT", 10)
    assert recommend.hot_items(seen).count() == 0  # each of the hundred has a hundredth of all rows

"""Models stored with their line form, loaded by another session and exchanged under a stream."""

import pytest
from pyspark.sql import functions as F

from tideline.functions.parsing import parse_keyed_csv, parse_label_space
from tideline.operators import models
from tideline.operators.models import train_nb, train_tree
from tideline.streaming import stored

LINES = ["0,9 1 0", "0,8 0 1", "1,1 9 0", "1,0 8 1", "2,0 1 9", "2,1 0 8"]
FLIPPED = [f"{2 - int(line[0])}{line[1:]}" for line in LINES]


def model_of(spark, lines):
    return train_nb(parse_label_space(spark.createDataFrame([(v,) for v in lines], "value STRING")))


def drop_lines(spark, folder, lines):
    spark.createDataFrame([(v,) for v in lines], "value STRING").coalesce(1).write.mode("append").text(folder)


def lines_of(spark, folder):
    return spark.readStream.text(folder)


def scores(spark, out):
    rows = spark.read.parquet(out).select("batch", "label", "prediction", "model_version").collect()
    return sorted((r["batch"], r["label"], r["prediction"], r["model_version"]) for r in rows)


def test_train_store_score_elsewhere_and_exchange(spark, tmp_path):
    store, folder, out = (str(tmp_path / n) for n in ("store", "in", "out"))
    assert stored.store_model(spark, model_of(spark, LINES), "label_space", store) == 1
    other = spark.newSession()
    drop_lines(spark, folder, LINES)
    query = stored.score_with_latest(lines_of(other, folder), store, out, str(tmp_path / "c"), interval="0 seconds", wait=False)
    try:
        query.processAllAvailable()
        first = [(0, float(line[0]), float(line[0]), 1) for line in LINES]
        assert scores(spark, out) == first
        # A newer model is taken by the next batch of the same running query.
        assert stored.store_model(spark, model_of(spark, FLIPPED), "label_space", store) == 2
        drop_lines(spark, folder, LINES[:3])
        query.processAllAvailable()
        second = [(1, float(line[0]), 2 - float(line[0]), 2) for line in LINES[:3]]
        assert scores(spark, out) == sorted(first + second)
        drop_lines(spark, folder, LINES[3:])
        query.processAllAvailable()
        assert {r[3] for r in scores(spark, out) if r[0] == 2} == {2}
    finally:
        query.stop()
    assert stored.load_model(other, store, 1).version == 1  # older versions stay


def test_a_version_without_its_card_is_not_there(spark, tmp_path):
    store = str(tmp_path / "store")
    assert stored.latest_version(spark, store) == 0
    with pytest.raises(ValueError, match="no model"):
        stored.load_model(spark, store)
    stored.store_model(spark, model_of(spark, LINES), "label_space", store)
    model_of(spark, FLIPPED).write().save(f"{store}/v2/model")
    assert stored.latest_version(spark, store) == 1
    assert stored.load_model(spark, store).version == 1


def test_trees_and_forms(spark, tmp_path):
    store = str(tmp_path / "store")
    keyed = spark.createDataFrame([(f"k{i},{i},{i % 3},{i % 7}",) for i in range(60)], "value STRING")
    rows = parse_keyed_csv(keyed).withColumn("label", F.substring("id", 2, 9).cast("double"))
    tree = train_tree(rows, "regressor", max_depth=3)
    stored.store_model(spark, tree, "keyed_csv", store)
    again = stored.load_model(spark.newSession(), store)
    assert again.form == "keyed_csv" and type(again.model) is type(tree)
    score = lambda m: sorted(map(tuple, models.score(m, rows).select("id", "prediction").collect()))
    assert score(again.model) == score(tree)
    with pytest.raises(ValueError, match="unknown line form"):
        stored.store_model(spark, tree, "xml", store)

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tideline.functions.parsing import parse_label_space
from tideline.operators import evaluate, matrix, models, prep
from tideline.sources.synthetic import gamma_matrix
from tideline.streaming import runtime, scoring

NB_LINES = ["0,1 0 0", "0,2 0 0", "1,0 1 0", "1,0 2 0", "2,0 0 1", "2,0 0 2"]


def labelled(spark, rows):
    return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in rows], ["label", "features"])


@pytest.fixture(scope="module")
def noisy(spark):
    """Three numeric slots and one categorical, with a label that depends on them."""
    i = F.col("id")
    a, b, c = F.pmod(i * 7, F.lit(13)), F.pmod(i * 5, F.lit(11)), F.pmod(i * 3, F.lit(4))
    return spark.range(2000).select(
        (a * 2 + F.when(b > 5, 10).otherwise(0) + c * c + F.pmod(i, F.lit(3))).cast("double").alias("label"),
        array_to_vector(F.array(*[x.cast("double") for x in (a, b, c)])).alias("features"))


def test_nb_golden(spark, lines):
    rows = parse_label_space(lines(*NB_LINES))
    model = models.train_nb(rows)
    found = {(r.label, r.feature): (r.log_prior, r.log_prob)
             for r in models.nb_parameters(spark, model).collect()}
    for (label, feature), (prior, prob) in found.items():
        assert math.isclose(prior, math.log(1 / 3))
        assert math.isclose(prob, math.log(4 / 6) if label == feature else math.log(1 / 6))
    assert evaluate.accuracy(models.score(model, rows)).first().accuracy == 1.0


def test_nb_stream_is_batch(spark, lines, tmp_path):
    model = models.train_nb(parse_label_space(lines(*NB_LINES)))
    lines(*NB_LINES).write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    got = runtime.drain_appends(scoring.score_stream(model, stream, "label_space"), "test-nb")
    assert sorted((r.label, r.prediction) for r in got.collect()) == [
        (y, y) for y in (0.0, 0.0, 1.0, 1.0, 2.0, 2.0)]


def test_tree_small(spark):
    rows = labelled(spark, [(0, [1.0, 0, 2.5]), (1, [0, 4.0, 0]), (0, [2.0, 0, 0]), (1, [0, 3.0, 1.0])])
    nodes = models.describe_tree(spark, models.train_tree(rows, "classifier")).orderBy("node").collect()
    assert (nodes[0].feature, nodes[0].threshold, nodes[0].n) == (0, 0.5, 4)
    assert [n.prediction for n in nodes[1:]] == [1.0, 0.0]
    assert nodes[1].feature is None and nodes[1].threshold is None


def test_leaf_is_the_mean_of_its_rows(noisy):
    model = models.train_tree(noisy, "regressor")
    leaves = models.score(model, noisy).groupBy("prediction").agg(F.avg("label").alias("mean"))
    rows = leaves.collect()
    assert 1 < len(rows) <= 32
    assert all(math.isclose(r.prediction, r.mean, abs_tol=1e-8) for r in rows)


def test_categorical_slots(spark, noisy):
    model = models.train_tree(noisy, "regressor", max_bins=286, categoricals={2: 285}, width=3)
    nodes = models.describe_tree(spark, model).where("feature = 2").collect()
    assert nodes and all(n.left_categories and n.threshold is None for n in nodes)
    with pytest.raises(ValueError):
        models.train_tree(noisy, "regressor", categoricals={2: 285}, width=3)


def test_tree_stream_is_batch_even_without_the_last_features(spark, lines, tmp_path):
    rows = labelled(spark, [(0, [1.0, 0, 2.5]), (1, [0, 4.0, 0]), (0, [2.0, 0, 0]), (1, [0, 3.0, 1.0])])
    model = models.train_tree(rows, "classifier")
    lines("# comment", "", " 5 1:1  ", "6", "7  2:3").write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    got = runtime.drain_appends(scoring.score_stream(model, stream, "libsvm"), "test-tree")
    assert {r.label: r.prediction for r in got.collect()} == {5.0: 0.0, 6.0: 1.0, 7.0: 1.0}


def test_keyed_stream(spark, lines, tmp_path):
    rows = labelled(spark, [(1, [0.0]), (9, [1.0]), (1, [0.0]), (9, [1.0])])
    lines("k1,0", "k2,1").write.text(str(tmp_path / "in"))
    scored = scoring.score_stream(
        models.train_tree(rows, "regressor"), spark.readStream.text(str(tmp_path / "in")), "keyed_csv")
    assert {r.id: r.prediction for r in runtime.drain_appends(scored, "test-keyed").collect()} == {
        "k1": 1.0, "k2": 9.0}


def test_metrics(spark):
    scored = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (2.0, 4.0)], "label DOUBLE, prediction DOUBLE")
    assert math.isclose(evaluate.accuracy(scored).first().accuracy, 1 / 3)
    assert math.isclose(evaluate.error_rate(scored).first().error_rate, 2 / 3)
    assert math.isclose(evaluate.mean_squared_error(scored).first().mse, 5 / 3)
    empty = evaluate.accuracy(scored.limit(0)).first()
    assert (empty.n, empty.accuracy) == (0, None)


def test_pca_invariants(spark):
    df = gamma_matrix(spark, 200, 20)
    rows = matrix.pca(df, 20).collect()
    loading, explained = np.zeros((20, 20)), np.zeros(20)
    for r in rows:
        loading[r.component, r.feature], explained[r.component] = r.loading, r.explained
    cov = np.zeros((20, 20))
    for r in matrix.covariance(df).collect():
        cov[r.i, r.j] = cov[r.j, r.i] = r.cov
    data = np.array([r[0] for r in df.select(vector_to_array("features")).collect()])
    assert np.allclose(cov, np.cov(data.T))
    assert np.allclose(loading @ loading.T, np.eye(20), atol=1e-8)
    values = explained * np.trace(cov)
    assert np.allclose(cov @ loading.T, loading.T * values, atol=1e-8)
    assert (np.diff(values) <= 1e-12).all()
    with pytest.raises(ValueError):
        matrix.pca(df, 21)


@pytest.fixture
def wide(spark):
    """A matrix of 700 columns with a few strong directions, and its rows as an array."""
    rng = np.random.default_rng(6)
    data = rng.standard_normal((300, 6)) * [9, 7, 5, 4, 3, 2] @ rng.standard_normal((6, 700)) + rng.standard_normal((300, 700))
    df = spark.createDataFrame([(row.tolist(),) for row in data], "v ARRAY<DOUBLE>").select(
        array_to_vector("v").alias("features"))
    return df.repartition(5), data


def test_covariance_of_many_blocks(wide, monkeypatch):
    df, data = wide
    expected = np.cov(data.T)
    for budget in (matrix.TASK_BYTES, 2 << 20):  # all tiles at once, and in several groups
        monkeypatch.setattr(matrix, "TASK_BYTES", budget)
        got = matrix.covariance(df).toPandas()
        assert len(got) == 700 * 701 // 2
        assert np.allclose(got["cov"], expected[got["i"], got["j"]], atol=1e-9)


def test_components_of_a_wide_matrix(wide, monkeypatch):
    df, data = wide
    cov = np.cov(data.T)
    values, vectors = np.linalg.eigh(cov)
    for most in (12, 2):  # one growing basis, and bases begun anew
        monkeypatch.setattr(matrix, "MOST_BASES", most)
        rows = matrix.pca(df, 5).toPandas()
        for c in range(5):
            mine = rows[rows["component"] == c].sort_values("feature")["loading"].to_numpy()
            assert abs(abs(mine @ vectors[:, -1 - c]) - 1) < 1e-9
            explained = rows[rows["component"] == c]["explained"].iloc[0]
            assert abs(explained - values[-1 - c] / np.trace(cov)) < 1e-9


def test_two_thousand_columns(spark):
    """The size the covariance is meant for, without an object of its size in the driver."""
    df = gamma_matrix(spark, 2000, 2000, seed=2)
    rows = matrix.pca(df, 3).toPandas()
    assert len(rows) == 6000 and (rows.groupby("component")["loading"].apply(lambda v: abs((v ** 2).sum() - 1)) < 1e-9).all()
    pieces, width = matrix.covariance_pieces(df)
    assert width == 2000 and pieces.count() == sum(8 - i // matrix.COLUMN_BLOCK for i in range(2000))


def test_one_row_has_no_covariance(spark):
    with pytest.raises(ValueError):
        matrix.covariance(gamma_matrix(spark, 1, 3))


def test_gamma_matrix_is_replayable(spark):
    one = {r.id: r.features for r in gamma_matrix(spark, 50, 4, seed=3).collect()}
    two = {r.id: r.features for r in gamma_matrix(spark, 50, 4, seed=3).repartition(7).collect()}
    other = {r.id: r.features for r in gamma_matrix(spark, 50, 4, seed=4).collect()}
    assert one == two and one != other and len({v[0] for v in one.values()}) == 50


def test_hash_split_is_stable(spark):
    df = spark.range(5000)
    parts = prep.split_hash(df, "id", [0.6, 0.3, 0.1])
    counts = [p.count() for p in parts]
    assert sum(counts) == 5000
    assert all(abs(c / 5000 - w) < 0.03 for c, w in zip(counts, (0.6, 0.3, 0.1)))
    again = prep.split_hash(df.repartition(9), "id", [0.6, 0.3, 0.1])[0]
    assert again.exceptAll(parts[0]).count() == 0


def test_persisted_releases(spark):
    df = spark.range(10)
    with prep.persisted(df) as kept:
        assert kept.count() == 10 and kept.is_cached
    assert not df.is_cached

from pyspark.sql import functions as F

from tideline.streaming.retained import retained_session
from tideline.plans import jobs
from tideline.sources.files import read_lines

from test_models import NB_LINES


def stream(spark, path):
    return spark.readStream.text(path).withColumn("timestamp", F.timestamp_seconds(F.lit(100)))


def write(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value STRING").write.text(path)
    return path


def test_naive_bayes(spark, tmp_path):
    path = write(spark, str(tmp_path / "in"), NB_LINES * 20)
    result = jobs.naive_bayes(spark, path, str(tmp_path / "out"))
    row = result.metric.first()
    assert row.accuracy == 1.0
    pairs = [r.value for r in read_lines(spark, str(tmp_path / "out")).collect()]
    assert len(pairs) == row.n and set(pairs) <= {"(0.0,0.0)", "(1.0,1.0)", "(2.0,2.0)"}
    query = jobs.score_messages(result.model, stream(spark, path), "label_space",
                                str(tmp_path / "c1"), trigger=None)
    assert query.exception() is None


def test_trees(spark, tmp_path):
    values = [f"{i % 2} 1:{i % 2 + 1}.0 3:{i % 5}" for i in range(100)]
    path = write(spark, str(tmp_path / "in"), values)
    classifier = jobs.decision_tree(spark, path, "classifier", num_features=3)
    assert classifier.metric.first().error_rate == 0.0
    regressor = jobs.decision_tree(spark, path, "regressor")
    assert regressor.metric.first().mse == 0.0
    query = jobs.score_messages(classifier.model, stream(spark, path), "libsvm",
                                str(tmp_path / "c"), trigger=None)
    assert query.exception() is None


def test_flights(spark, tmp_path):
    slots = [",".join(str((i * k) % 7) for k in range(1, 10)) for i in range(600)]
    history = write(spark, str(tmp_path / "h"), [f"{i % 7 * 3},{s}" for i, s in enumerate(slots)])
    schedule = write(spark, str(tmp_path / "s"), [f"f{i},{s}" for i, s in enumerate(slots)])
    out = str(tmp_path / "out")
    result = jobs.flight_delays(spark, history, 9, schedule, out)
    assert result.metric.first().mse < 1.0
    rows = [r.value for r in read_lines(spark, out).collect()]
    assert len(rows) == 600 and all(r.startswith("(0,f") and r.endswith(",0)") for r in rows)
    query = jobs.score_messages(result.model, stream(spark, schedule), "keyed_csv",
                                str(tmp_path / "c"), trigger=None)
    assert query.exception() is None


def test_components(spark):
    assert jobs.principal_components(spark, size=30, k=3).count() == 90


def test_recommenders(spark, tmp_path, small_ratings, pearson_ratings):
    def csv(df, name):
        df.write.csv(str(tmp_path / name))
        return str(tmp_path / name)

    one = jobs.recommend_for_user(spark, csv(pearson_ratings, "p"))
    assert [r.item_id for r in one.orderBy("rank").collect()] == [12, 13, 14]
    small = csv(small_ratings, "s")
    assert jobs.recommend_for_all(spark, small).count() == 6
    out = str(tmp_path / "recs")
    assert jobs.recommend_by_items(spark, small, out).count() == 14
    assert read_lines(spark, out).count() == 5


def test_streams(spark, tmp_path):
    numbers = stream(spark, write(spark, str(tmp_path / "n"), ["3", "4"]))
    words = stream(spark, write(spark, str(tmp_path / "w"), ["a b a"]))
    kept = stream(retained_session(spark), str(tmp_path / "w"))
    for number, query in enumerate([
        jobs.average_messages(numbers, str(tmp_path / "c0"), trigger=None),
        jobs.count_words(words, str(tmp_path / "c1"), keep_expired=False, trigger=None),
        jobs.count_words(kept, str(tmp_path / "c2"), lateness="1 minute", trigger=None),
        jobs.count_events(words, str(tmp_path / "c3"), trigger=None),
    ]):
        assert query.exception() is None, number

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tideline.session import materialise, shared_dir
from tideline.sinks import messages, text
from tideline.sources import files, streams, synthetic


def test_ratings_skip_blank_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,10,1.0\n\n1,11,2.5\n\n2,10,0.5\n")
    rows = files.read_ratings(spark, str(tmp_path / "r.csv")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 10, 1.0), (1, 11, 2.5), (2, 10, 0.5)]


def test_ratings_malformed_fails(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,10,good\n")
    with pytest.raises(Exception):
        files.read_ratings(spark, str(tmp_path / "r.csv")).collect()


def test_libsvm(spark, tmp_path):
    (tmp_path / "d.txt").write_text("0 1:1.0 3:2.5\n1 2:4\n")
    for width in (None, 3):
        rows = files.read_libsvm(spark, str(tmp_path / "d.txt"), width).orderBy("label").collect()
        assert rows[0].features.toArray().tolist() == [1.0, 0.0, 2.5]


def test_tuples(spark, tmp_path):
    path = str(tmp_path / "out")
    scored = spark.createDataFrame([("k1", 2.5), ("k2", None)], "id STRING, prediction DOUBLE")
    text.write_tuples(text.scored_tuple(scored), path)
    assert sorted(r.value for r in files.read_lines(spark, path).collect()) == [
        "(0,k1,2.5,0)", "(0,k2,null,0)"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        text.write_tuples(scored, path)


def test_kafka_options():
    options = streams.kafka_options("h:1", " a, b ", min_partitions=8, max_rows=100)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
        "minPartitions": "8", "maxOffsetsPerTrigger": "100"}
    assert messages.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    with pytest.raises(ValueError):
        streams.kafka_options("h:1", " ,")


def test_stream_lines_from_a_folder(spark, tmp_path, lines):
    lines("a", "b").write.text(str(tmp_path / "in"))
    stream = streams.stream_lines(spark, path=str(tmp_path / "in"), max_files=1)
    assert stream.columns == ["value", "timestamp"] and stream.isStreaming
    with pytest.raises(ValueError):
        streams.stream_lines(spark, "carrier-pigeon")


def test_digit_messages(spark):
    rows = spark.range(1000).select(synthetic.digit_message(F.col("id"), 4, seed=1).alias("m")).collect()
    digits = [d for r in rows for d in r.m.split(" ")]
    assert len(digits) == 4000 and set(digits) == set("0123456789")
    assert synthetic.word_stream(spark, 5, 4).columns == ["value", "timestamp"]


def test_console_sink(spark, tmp_path, lines, capfd):
    lines("hello").write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    query = messages.console_sink(stream).trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "c")).start()
    assert query.awaitTermination(60)
    assert query.exception() is None


def fake_session(configured, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured),
        sparkContext=SimpleNamespace(master=master, applicationId=f"{configured}-{master}"))


def test_shared_dir_follows_the_session():
    assert shared_dir(fake_session("s3://b/c/", "yarn"), "x").startswith("s3://b/c/tideline/x-")
    local = fake_session(None, "local[2]")
    first, second = shared_dir(local, "x"), shared_dir(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        shared_dir(fake_session(None, "spark://host:7077"), "x")


def test_materialise(spark):
    df = materialise(spark.range(5), "numbers")
    assert df.count() == 5 and df.columns == ["id"]


@pytest.mark.parametrize("line", [",4,2.0", "1,3,", "1,,2.0", "1,2", "1,2,3,4"])
def test_rating_lines_with_missing_fields_fail(spark, tmp_path, line):
    (tmp_path / "r.csv").write_text(f"1,2,3.0\n\n{line}\n")
    with pytest.raises(Exception):
        files.read_ratings(spark, str(tmp_path / "r.csv")).collect()


def test_boolean_rating_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,2\n\n 3 , 4 ,5.5\n")
    rows = files.read_ratings(spark, str(tmp_path / "r.csv"), boolean=True).collect()
    assert sorted(map(tuple, rows)) == [(1, 2, 1.0), (3, 4, 1.0)]

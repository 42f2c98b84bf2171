"""Windows on tables, and the same on streams."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.functions.parsing import parse_int, tokenize
from tideline.operators.aggregates import int_average, word_count
from tideline.streaming import runtime, windows
from tideline.streaming.intervals import streaming_average_reported
from tideline.streaming.retained import PaneCounts, retained_session, sliding_word_count_retained

MESSAGES = "value STRING, timestamp TIMESTAMP"


def stamped(spark, rows):
    return spark.createDataFrame(rows, "value STRING, at BIGINT").select(
        "value", F.timestamp_seconds("at").alias("timestamp"))


def stream_of(spark, path, batches):
    """A stream that delivers one file per micro-batch."""
    for number, rows in enumerate(batches):
        stamped(spark, rows).coalesce(1).write.parquet(f"{path}/part{number:03d}")
    return (
        spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(str(path)))


def seconds(df, *columns):
    return sorted(
        tuple(int(r[c].timestamp()) if c.startswith("window") else r[c] for c in columns)
        for r in df.collect())


@pytest.mark.parametrize("values,expected", [
    ([3, 4], (2, 7, 3, 3.5)), ([-3, -4], (2, -7, -3, -3.5)), ([], (0, None, None, None)),
    ([2147483647] * 3, (3, 6442450941, 2147483647, 2147483647.0)),
])
def test_int_average(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "number INT")
    assert tuple(int_average(df).first()) == expected


def test_word_count(lines):
    got = {r.word: r.cnt for r in word_count(tokenize(lines("a b a"))).collect()}
    assert got == {"a": 2, "b": 1}


def test_average_fills_empty_intervals(spark):
    df = parse_int(stamped(spark, [("3", 0), ("4", 5), ("-7", 31)]))
    got = seconds(windows.streaming_average(df, "10 seconds"), "window_start", "n", "avg_int")
    assert got[1:3] == [(10, 0, None), (20, 0, None)]
    assert (got[0], got[3]) == ((0, 2, 3), (30, 1, -7))


def test_windows_of_nothing(spark):
    none = stamped(spark, []).select("timestamp", F.col("value").cast("int").alias("number"))
    assert windows.streaming_average(none, "10 seconds").count() == 0
    words = stamped(spark, []).withColumnRenamed("value", "word")
    assert windows.sliding_word_count(words, keep_expired=True).count() == 0


def test_counts_report(spark):
    rows = windows.batch_counts(stamped(spark, [("a", 0), ("b", 1), ("c", 5)]), "2 seconds")
    assert [r.message.split()[1] for r in rows.orderBy("window_start").collect()] == ["2", "0", "1"]


def test_sliding_counts_with_and_without_zeros(spark):
    words = tokenize(stamped(spark, [("a b a", 0), ("c", 1), ("d", 7)]))
    plain = seconds(windows.sliding_word_count(words, "5 seconds", "1 second"), "window_end", "word", "cnt")
    assert [r for r in plain if r[0] == 1] == [(1, "a", 2), (1, "b", 1)]
    assert [r for r in plain if r[0] == 6] == [(6, "c", 1)]
    kept = seconds(windows.sliding_word_count(words, "5 seconds", "1 second", keep_expired=True),
                   "window_end", "word", "cnt")
    assert [r for r in kept if r[0] == 6] == [(6, "a", 0), (6, "b", 0), (6, "c", 1)]
    assert [r for r in kept if r[0] == 7] == [(7, "a", 0), (7, "b", 0), (7, "c", 0)]
    assert set(plain) == {r for r in kept if r[2] > 0}


# Later batches hold messages that are days earlier than those before them.
BATCHES = [[("3", 900_000), ("4", 900_005)], [("10", 12)], [("-7", 31), ("-8", 500_033)], [("1", 14), ("2", 900_001)]]


def test_stream_average_is_the_table_average(spark, tmp_path):
    stream = parse_int(stream_of(spark, tmp_path / "in", BATCHES))
    averages = windows.streaming_average(stream, "10 seconds")
    got = runtime.drain_updates(averages, ["window_start", "window_end"], "test-average")
    table = windows.streaming_average(
        parse_int(stamped(spark, [r for b in BATCHES for r in b])), "10 seconds")
    columns = ("window_start", "n", "total", "avg_int")
    assert seconds(got, *columns) == seconds(table.where("n > 0"), *columns)


def test_stream_words_are_the_table_words(spark, tmp_path):
    batches = [[("a b a", 0)], [("c", 1), ("a", 1)], [("d", 7)]]
    stream = tokenize(stream_of(spark, tmp_path / "in", batches))
    got = runtime.drain_updates(windows.sliding_word_count(stream, "5 seconds", "1 second"),
                                ["window_start", "window_end", "word"], "test-words")
    table = windows.sliding_word_count(
        tokenize(stamped(spark, [r for b in batches for r in b])), "5 seconds", "1 second")
    columns = ("window_start", "word", "cnt")
    assert seconds(got, *columns) == seconds(table, *columns)


def test_stream_keeps_expired_words(spark, tmp_path):
    batches = [[("a b a", 0)], [("c", 1)], [("z", 9)], [("z", 30)], [("y", 31)]]
    words = tokenize(stream_of(retained_session(spark), tmp_path / "in", batches))
    counts = sliding_word_count_retained(words, "0 seconds", "5 seconds", "1 second")
    got = runtime.drain_appends(counts, "test-retained")
    table = windows.sliding_word_count(
        tokenize(stamped(spark, [r for b in batches for r in b])), "5 seconds", "1 second",
        keep_expired=True)
    columns = ("window_end", "word", "cnt")
    # The watermark ends at the last event, so later windows are still open.
    assert seconds(got, *columns) == [r for r in seconds(table, *columns) if r[0] <= 31]


def test_retained_window_must_be_a_multiple(spark, tmp_path):
    words = tokenize(stream_of(spark, tmp_path / "in", [[("a", 0)]]))
    with pytest.raises(ValueError):
        sliding_word_count_retained(words, "0 seconds", "5 seconds", "2 seconds")


def test_empty_batches_are_skipped_and_restart_resumes(spark, tmp_path):
    source, checkpoint, seen = tmp_path / "in", str(tmp_path / "checkpoint"), []
    stream = stream_of(spark, source, [[("1", 0)], [("x", 1)]])
    numbers = parse_int(stream, strict=False)

    def note(batch, batch_id):
        seen.append((batch_id, batch.count()))

    runtime.start_query(runtime.for_each_batch(numbers, note), checkpoint)
    assert seen == [(0, 1)]  # the second batch has no well-formed message
    stamped(spark, [("2", 2), ("3", 2)]).coalesce(1).write.parquet(f"{source}/part900")
    runtime.start_query(runtime.for_each_batch(numbers, note), checkpoint)
    assert seen == [(0, 1), (2, 2)]


def test_append_drain_of_an_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(MESSAGES).parquet(str(tmp_path / "in"))
    assert runtime.drain_updates(stream, ["value"], "test-none").count() == 0


def test_panes_are_counted_before_they_are_spread(spark):
    words = tokenize(stamped(spark, [("a", 0)]))
    plan = windows.sliding_word_count(words)._jdf.queryExecution().optimizedPlan().toString()
    lines = [l for l in plan.splitlines() if "Expand" in l or "Aggregate" in l]
    assert len(lines) == 3 and "Expand" in lines[1]  # aggregate over spread over aggregate


def test_rows_behind_the_watermark_are_an_error(spark, tmp_path):
    stream = parse_int(stream_of(spark, tmp_path / "in", BATCHES))
    averages = windows.streaming_average(stream, "10 seconds", lateness="1 minute")
    with pytest.raises(ValueError, match="later than the watermark"):
        runtime.drain_updates(averages, ["window_start", "window_end"], "test-late")


def test_intervals_are_filled_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(windows, "STRETCH", 7)
    table = windows.batch_counts(stamped(spark, [("a", 0), ("b", 200), ("c", 999)]), "2 seconds")
    assert seconds(table, "window_start", "n") == [(t, int(t in (0, 200, 998))) for t in range(0, 1000, 2)]


def test_retained_totals_after_a_long_jump(spark, tmp_path):
    batches = [[("a", i) for i in range(0, 40, 3)], [("z", 3000)]]
    words = tokenize(stream_of(retained_session(spark), tmp_path / "in", batches))
    got = runtime.drain_appends(sliding_word_count_retained(words, "1 hour", "20 seconds", "1 second"), "test-jump")
    assert got.count() == 0  # all windows are still open
    words = tokenize(stream_of(retained_session(spark), tmp_path / "in2", batches))
    got = runtime.drain_appends(sliding_word_count_retained(words, "0 seconds", "20 seconds", "1 second"), "test-jump")
    found = dict(seconds(got.where("word = 'a'"), "window_end", "cnt"))
    assert found == {e: sum(1 for i in range(0, 40, 3) if e - 20 <= i < e) for e in range(1, 3001)}


def test_stream_panes_are_the_table_windows(spark, tmp_path):
    batches = [[("a b a", 0), ("a", 33)], [("c", 1), ("b", 2)], [("a", 90), ("c", 3)], [("z", 500)]]
    words = tokenize(stream_of(retained_session(spark), tmp_path / "in", batches))
    counts = sliding_word_count_retained(words, "200 seconds", "20 seconds", "5 seconds", keep_expired=False)
    got = runtime.drain_appends(counts, "test-panes")
    table = windows.sliding_word_count(
        tokenize(stamped(spark, [r for b in batches for r in b])), "20 seconds", "5 seconds")
    columns = ("window_end", "word", "cnt")
    assert seconds(got, *columns) == [r for r in seconds(table, *columns) if r[0] <= 300]


class Handle:
    """What a stateful processor asks of its handle, for one key."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Clock:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_state_of_a_word_holds_one_window_of_panes():
    processor, handle = PaneCounts(120_000, 10_000, keep_expired=False), Handle()
    processor.init(handle)
    seen = {}
    for pane in range(0, 3_000_000, 10_000):
        if pane % 700_000 < 400_000:  # the word comes and goes
            processor.handleInputRows(("w",), iter([pd.DataFrame({"pane_ms": [pane], "cnt": [1]})]), None)
        for frame in processor.handleExpiredTimer(("w",), Clock(pane + 10_000), None):
            seen.update(zip(frame["window_end"].astype("int64"), frame["cnt"]))
        assert handle.value is None or len(handle.value[1]) <= 12
    assert min(seen.values()) == 1 and max(seen.values()) == 12
    assert handle.value is None or handle.value[1]


def test_stream_reports_empty_intervals(spark, tmp_path):
    own = retained_session(spark)
    batches = [[("3", 95), ("4", 7)], [("10", 12)], [("-7", 31)], [("1", 14), ("5", 300)]]
    stream = parse_int(stream_of(own, tmp_path / "in", batches))
    reported = streaming_average_reported(stream, "200 seconds")
    got = runtime.drain_appends(reported, "test-reported")
    table = windows.streaming_average(parse_int(stamped(spark, [r for b in batches for r in b])), "10 seconds")
    columns = ("window_start", "n", "total", "avg_int", "avg")
    # The watermark ends at 100: ten intervals from the first, six without input.
    assert seconds(got, *columns) == [r for r in seconds(table, *columns) if r[0] < 100]
    assert [r[1] for r in seconds(got, *columns)] == [1, 2, 0, 1, 0, 0, 0, 0, 0, 1]


def test_silence_before_the_next_input_is_reported(spark, tmp_path):
    own, source, checkpoint = retained_session(spark), tmp_path / "in", str(tmp_path / "checkpoint")

    def run():
        stream = parse_int(own.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", "true").parquet(str(source)))
        writer = streaming_average_reported(stream, "0 seconds").writeStream.format("parquet").option(
            "path", str(tmp_path / "out"))
        runtime.start_query(writer, checkpoint)
        return seconds(spark.read.parquet(str(tmp_path / "out")), "window_start", "n")

    stamped(spark, [("1", 0), ("1", 3), ("2", 45)]).coalesce(1).write.parquet(f"{source}/part0")
    assert run() == [(0, 2), (10, 0), (20, 0), (30, 0)]
    stamped(spark, [("2", 70)]).coalesce(1).write.parquet(f"{source}/part1")
    assert run() == [(0, 2), (10, 0), (20, 0), (30, 0), (40, 1), (50, 0), (60, 0)]

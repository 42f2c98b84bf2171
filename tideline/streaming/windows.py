"""Windowed aggregates. Each works on a table and on a stream.

On a table, intervals without input are filled in; on a stream only intervals
with input can appear. A stream has no watermark unless ``lateness`` is given: in
update mode every row counts, however late, and the state keeps all intervals.
With ``lateness`` older state is let go, and rows later than that are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tideline.operators.aggregates import average_columns, with_averages

STRETCH = 10_000

def _stamped(df: DataFrame, time: str, lateness: str | None) -> DataFrame:
    return df.withWatermark(time, lateness) if df.isStreaming and lateness else df


def _flat_window(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def _step(interval: str) -> Column:
    return F.expr(f"INTERVAL {interval}")


def _fill_intervals(counts: DataFrame, interval: str) -> DataFrame:
    """Every interval from first to last, joined with the (few) ones that have rows.

    The grid is made in two steps, stretches of ``STRETCH`` intervals and then the
    intervals of each, so that no row holds them all.
    """
    step = _step(interval)
    bounds = counts.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last"))
    stretches = bounds.where(F.col("first").isNotNull()).select(
        "last", F.explode(F.sequence("first", "last", step * F.lit(STRETCH))).alias("begin"))
    grid = stretches.repartition("begin").select(
        F.explode(F.sequence("begin", F.least("last", F.col("begin") + step * F.lit(STRETCH - 1)), step))
        .alias("window_start")
    ).withColumn("window_end", F.col("window_start") + step)
    found = counts.drop("window_end")
    return grid.join(found, "window_start", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def streaming_average(df: DataFrame, interval: str = "10 seconds", number: str = "number",
                      time: str = "timestamp", lateness: str | None = None) -> DataFrame:
    """Average of each interval by itself: (window_start, window_end, n, total, avg_int, avg)."""
    counts = _flat_window(
        _stamped(df, time, lateness).groupBy(F.window(time, interval).alias("window"))
        .agg(*average_columns(number))
    )
    return with_averages(counts if df.isStreaming else _fill_intervals(counts, interval))


def batch_counts(df: DataFrame, interval: str = "2 seconds", time: str = "timestamp",
                 lateness: str | None = None) -> DataFrame:
    """Events per interval, with the report line: (window_start, window_end, n, message)."""
    counts = _flat_window(
        _stamped(df, time, lateness).groupBy(F.window(time, interval).alias("window"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if not df.isStreaming:
        counts = _fill_intervals(counts, interval)
    # Fixed value: the report's wording.
    return counts.withColumn("message", F.format_string("Received %d flume events.", F.col("n")))


def sliding_word_count(words: DataFrame, window: str = "2 minutes", slide: str = "10 seconds",
                       time: str = "timestamp", keep_expired: bool = False,
                       lateness: str | None = None) -> DataFrame:
    """(window_start, window_end, word, cnt) for a ``word`` column.

    A table is first counted per slide-long pane and only the pane counts are
    spread over the windows that hold them. ``keep_expired`` keeps a word that
    was seen once in every later window, as 0 when it is gone.
    """
    if words.isStreaming:
        if keep_expired:
            raise ValueError("use sliding_word_count_retained for a stream with expired words")
        counts = (
            _stamped(words, time, lateness)
            .groupBy(F.window(time, window, slide).alias("window"), "word")
            .agg(F.count(F.lit(1)).alias("cnt"))
        )
        return _flat_window(counts)
    panes = (
        words.groupBy(F.window(time, slide).alias("pane"), "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("pane.start").alias("pane_start"), "word", "cnt")
    )
    counts = _flat_window(
        panes.groupBy(F.window("pane_start", window, slide).alias("window"), "word")
        .agg(F.sum("cnt").alias("cnt"))
    )
    if not keep_expired:
        return counts
    # The last window starts with the last pane.
    last = panes.agg(F.max("pane_start")).scalar()
    return _retain(counts, last, window, slide)


def _retain(counts: DataFrame, last: Column, window: str, slide: str) -> DataFrame:
    """Add the zero rows: each word, from its first window to the last of all.

    A word's counted windows are followed by zeros up to the next counted one.
    """
    following = F.lead("window_start").over(W.partitionBy("word").orderBy("window_start"))
    bounded = counts.withColumn("until", F.coalesce(following - _step(slide), last))
    spread = bounded.select(
        "word", "cnt",
        F.posexplode(F.sequence("window_start", "until", _step(slide))).alias("pos", "window_start"),
    )
    return spread.select(
        "window_start",
        (F.col("window_start") + _step(window)).alias("window_end"),
        "word",
        F.when(F.col("pos") == 0, F.col("cnt")).otherwise(F.lit(0)).alias("cnt"),
    )

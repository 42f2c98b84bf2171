"""Sliding counts of a stream by panes: rows are counted once per slide, windows summed in the state.

A word seen once can be reported forever, as 0 when it is gone, or only while it is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "word STRING, window_start TIMESTAMP, window_end TIMESTAMP, cnt BIGINT"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK = 50_000  # windows reported in one go


class PaneCounts(StatefulProcessor):
    """Per word, in one value: counts of the panes still in a window, and the next window end to report.

    The panes are those of one window at most, once the watermark has passed the word's first.
    A timer on that end reports every window the watermark has passed, then waits for the
    following one; with ``keep_expired`` it is set again even when no pane is left, else
    the word is forgotten until it comes back.
    """

    def __init__(self, window_ms: int, slide_ms: int, keep_expired: bool) -> None:
        self.window_ms, self.slide_ms, self.keep_expired = window_ms, slide_ms, keep_expired

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", "due BIGINT, starts ARRAY<BIGINT>, counts ARRAY<BIGINT>")

    def _held(self) -> tuple[int | None, dict[int, int]]:
        if not self.state.exists():
            return None, {}
        due, starts, counts = self.state.get()
        return due, dict(zip(starts, counts, strict=True))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, panes = self._held()
        earliest = None
        for batch in rows:
            for start, cnt in zip(batch["pane_ms"].tolist(), batch["cnt"].tolist(), strict=True):
                panes[start] = panes.get(start, 0) + cnt
                earliest = start if earliest is None else min(earliest, start)
        if earliest is not None:
            end = earliest + self.slide_ms
            if due is None or end < due:
                due = end
                self.handle.registerTimer(end)
            self.state.update((due, list(panes), list(panes.values())))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, panes = self._held()
        if due is None:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        starts = np.array(sorted(panes), dtype=np.int64)
        running = np.concatenate([[0], np.cumsum([panes[s] for s in starts.tolist()], dtype=np.int64)])
        following = due + self.slide_ms * max(0, (watermark - due) // self.slide_ms + 1)
        if self.keep_expired:
            ends = np.arange(due, following, self.slide_ms)
        else:
            ends = np.unique(starts[:, None] + np.arange(self.slide_ms, self.window_ms + 1, self.slide_ms))
            ends = ends[(ends >= due) & (ends < following)]
        left = starts[starts >= following - self.window_ms].tolist()
        if left or self.keep_expired:
            self.state.update((following, left, [panes[s] for s in left]))
            self.handle.registerTimer(following)
        else:
            self.state.clear()
        for at in range(0, len(ends), CHUNK):
            some = ends[at:at + CHUNK]
            # A window's total is the difference of two running sums over the panes.
            totals = running[np.searchsorted(starts, some)] - running[np.searchsorted(starts, some - self.window_ms)]
            stamps = pd.to_datetime(pd.Series(some), unit="ms")
            yield pd.DataFrame({
                "word": key[0],
                "window_start": stamps - pd.Timedelta(milliseconds=self.window_ms),
                "window_end": stamps,
                "cnt": totals,
            })

    def close(self) -> None:
        pass


def milliseconds(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def retained_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the state store that timed state needs."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def sliding_word_count_retained(words: DataFrame, lateness: str, window: str = "2 minutes",
                                slide: str = "10 seconds", time: str = "timestamp",
                                keep_expired: bool = True) -> DataFrame:
    """(word, window_start, window_end, cnt), appended once the watermark passes a window.

    Rows later than ``lateness`` are dropped; the choice is the caller's. Words are
    counted per pane first, so a row is never copied to the windows that hold it and a frequent
    word reaches its state as one row per pane. ``keep_expired`` reports a word that was seen
    once in every later window. Needs the RocksDB state store: see :func:`retained_session`.
    """
    window_ms, slide_ms = milliseconds(window), milliseconds(slide)
    if window_ms % slide_ms:
        raise ValueError("the window must be a multiple of the slide")
    panes = (
        words.withWatermark(time, lateness)
        .groupBy(F.window(time, slide).alias("pane"), "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("word", F.unix_millis("pane.start").alias("pane_ms"), "cnt")
    )
    return panes.groupBy("word").transformWithStateInPandas(
        PaneCounts(window_ms, slide_ms, keep_expired), OUTPUT, outputMode="Append", timeMode="EventTime"
    )

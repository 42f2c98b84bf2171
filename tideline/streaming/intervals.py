"""Averages of a stream for every interval, also of those that pass without input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.operators.aggregates import average_columns, with_averages
from tideline.streaming.retained import CHUNK, milliseconds

OUTPUT = "window_start TIMESTAMP, window_end TIMESTAMP, n BIGINT, total BIGINT"


class IntervalReport(StatefulProcessor):
    """Reports each interval when the watermark passes its end: its sums, or n = 0 and no total.

    Holds the first interval not yet reported and the sums of those that are to come.
    """

    def __init__(self, interval_ms: int) -> None:
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "sums", "due BIGINT, starts ARRAY<BIGINT>, ns ARRAY<BIGINT>, totals ARRAY<BIGINT>")

    def _held(self) -> tuple[int | None, dict[int, tuple]]:
        if not self.state.exists():
            return None, {}
        due, starts, ns, totals = self.state.get()
        return due, {s: (n, t) for s, n, t in zip(starts, ns, totals, strict=True)}

    def _keep(self, due: int, sums: dict[int, tuple]) -> None:
        self.state.update((due, list(sums), [n for n, _ in sums.values()], [t for _, t in sums.values()]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, sums = self._held()
        for batch in rows:
            for start, n, total in zip(batch["start_ms"].tolist(), batch["n"].tolist(), batch["total"].tolist(), strict=True):
                # An interval without numbers has rows, but no total.
                sums[start] = (n, int(total) if n else 0)
                if due is None or start < due:
                    due = start
                    self.handle.registerTimer(start + self.interval_ms)
        if due is not None:
            self._keep(due, sums)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, sums = self._held()
        passed = (timerValues.getCurrentWatermarkInMs() - due) // self.interval_ms
        following = due + self.interval_ms * max(0, passed)
        starts = np.arange(due, following, self.interval_ms)
        self._keep(following, {s: v for s, v in sums.items() if s >= following})
        self.handle.registerTimer(following + self.interval_ms)
        for at in range(0, len(starts), CHUNK):
            some = starts[at:at + CHUNK]
            found = [sums.get(s, (0, 0)) for s in some.tolist()]
            stamps = pd.to_datetime(pd.Series(some), unit="ms")
            yield pd.DataFrame({
                "window_start": stamps,
                "window_end": stamps + pd.Timedelta(milliseconds=self.interval_ms),
                "n": [n for n, _ in found],
                "total": pd.array([t if n else None for n, t in found], dtype="Int64"),
            })

    def close(self) -> None:
        pass


def streaming_average_reported(df: DataFrame, lateness: str, interval: str = "10 seconds",
                               number: str = "number", time: str = "timestamp") -> DataFrame:
    """(window_start, window_end, n, total, avg_int, avg) of every interval from the first, gaps included.

    Appended when the watermark passes an interval's end; rows later than ``lateness`` are dropped. Numbers
    are added up per interval first, so that the report, which is one key, gets a row per
    interval. A row without a number moves the time on and counts as nothing. Needs the RocksDB
    state store: see :func:`~tideline.streaming.retained.retained_session`.
    """
    sums = (
        df.withWatermark(time, lateness).groupBy(F.window(time, interval).alias("window"))
        .agg(*average_columns(number))
        .select(F.lit(0).alias("all"), F.unix_millis("window.start").alias("start_ms"), "n",
                F.coalesce("total", F.lit(0)).alias("total"))
    )
    reported = sums.groupBy("all").transformWithStateInPandas(
        IntervalReport(milliseconds(interval)), OUTPUT, outputMode="Append", timeMode="EventTime")
    return with_averages(reported)

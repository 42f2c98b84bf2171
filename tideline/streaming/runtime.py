"""Running streams: triggers, per-batch callbacks, sinks that can be read back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tideline.session import shared_dir


def start_query(writer: DataStreamWriter, checkpoint: str, interval: str | None = None,
                timeout: float | None = None, wait: bool = True) -> StreamingQuery:
    """Start a stream with its own checkpoint folder.

    ``interval`` is the micro-batch interval; without one, all waiting input is
    worked off and the query ends. State is kept in as many partitions as the
    session shuffles to at the first start.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    query = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if wait:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return query


def _complete(query: StreamingQuery) -> None:
    """Raise if the stream has left out rows that came after its watermark."""
    dropped = sum(state.numRowsDroppedByWatermark for progress in query.recentProgress
                  for state in progress.stateOperators)
    if dropped:
        raise ValueError(f"{dropped} rows came later than the watermark allows and were dropped")


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None],
                   mode: str = "append") -> DataStreamWriter:
    """A writer that calls ``fn(batch, batch_id)``, leaving empty batches out."""

    def call(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            fn(batch, batch_id)

    return df.writeStream.outputMode(mode).foreachBatch(call)


def _read_table(df: DataFrame, path: str) -> DataFrame:
    # The schema is given, so a stream without output reads as an empty table.
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)


def drain_appends(df: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over all waiting input; return what it wrote."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    writer = df.writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows")
    _complete(start_query(writer, f"{path}/checkpoint"))
    return _read_table(df, f"{path}/rows")


def drain_updates(df: DataFrame, keys: Sequence[str], purpose: str) -> DataFrame:
    """Run an update stream over all waiting input; return the last row per key.

    Each batch writes its own folder, overwritten if the batch is run again, so
    a restart leaves every update once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    spark.createDataFrame([], df.schema).write.parquet(f"{path}/rows/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    _complete(start_query(for_each_batch(df, write, mode="update"), f"{path}/checkpoint"))
    written = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col("batch"))
    return written.groupBy(*keys).agg(last.alias("last")).select(
        *keys, *[F.col(f"last.{c}").alias(c) for c in rest]
    ).select(*df.columns)

"""Console and Kafka sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

CONSOLE_ROWS = 10


def console_sink(df: DataFrame, rows: int = CONSOLE_ROWS, mode: str = "append") -> DataStreamWriter:
    """A writer that prints the first rows of every micro-batch."""
    return (
        df.writeStream.outputMode(mode).format("console")
        .option("numRows", str(rows)).option("truncate", "false")
    )


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(df: DataFrame, servers: str, topic: str, line: str = "value",
                checkpoint: str | None = None):
    """Send ``line`` as text messages; returns the running query for a stream."""
    messages = df.selectExpr(f"CAST(`{line}` AS STRING) AS value")
    options = kafka_sink_options(servers, topic)
    if df.isStreaming:
        return (
            messages.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start()
        )
    return messages.write.format("kafka").options(**options).save()

"""Message streams with one shape: ``value STRING, timestamp TIMESTAMP``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def kafka_options(servers: str, topics: str, starting: str = "latest",
                  min_partitions: int | None = None, max_rows: int | None = None) -> dict[str, str]:
    """Options of the Kafka reader; ``topics`` is a comma-separated list."""
    names = [t.strip() for t in topics.split(",") if t.strip()]
    if not names:
        raise ValueError("no topic given")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting,
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def stream_table(spark: SparkSession, path: str, schema: StructType,
                 max_files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` (file, folder or glob) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    # The file source wants a folder or a pattern, so a plain file name becomes
    # a pattern that matches just that name.
    return reader.parquet(path if "*" in path else f"{path[:-1]}[{path[-1]}]")


def stream_lines(spark: SparkSession, kind: str = "files", *, path: str | None = None,
                 max_files: int | None = None, servers: str | None = None,
                 topics: str | None = None, starting: str = "latest",
                 min_partitions: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Lines from Kafka topics (message key dropped) or from a landing folder."""
    if kind == "kafka":
        options = kafka_options(servers, topics, starting, min_partitions, max_rows)
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.col("value").cast("string").alias("value"), "timestamp")
    if kind != "files":
        raise ValueError(f"unknown stream kind: {kind}")
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.text(path)
    return raw.select(
        "value", F.col("_metadata.file_modification_time").cast("timestamp").alias("timestamp")
    )

"""Aggregates over messages. All are partial-then-final hash aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def average_columns(number: str = "number") -> list[Column]:
    """Partial-aggregate inputs of the average: how many, and their sum."""
    return [
        F.count(F.col(number)).alias("n"),
        F.sum(F.col(number).cast("bigint")).alias("total"),
    ]


def with_averages(df: DataFrame) -> DataFrame:
    """Add ``avg_int`` (truncated toward zero) and exact ``avg``; NULL where n = 0."""
    some = F.col("n") > 0
    return df.withColumn("avg_int", F.when(some, F.expr("total div n"))).withColumn(
        "avg", F.when(some, F.col("total") / F.col("n"))
    )


def int_average(df: DataFrame, number: str = "number") -> DataFrame:
    """One row (n, total, avg_int, avg); an empty input gives n = 0 and NULLs."""
    return with_averages(df.agg(*average_columns(number)))


def word_count(words: DataFrame) -> DataFrame:
    """(word, cnt) of a ``word`` column."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))

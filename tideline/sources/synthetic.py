"""Replayable generators: the same key and seed give the same row on any executor."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Multiplier, increment and modulus of the C library's linear
# congruential generator.
MULTIPLIER = 1103515245
INCREMENT = 12345
MODULUS = 2147483648


def gamma_rows(keys: DataFrame, key: str, cols: int, shape: float, scale: float,
               seed: int) -> DataFrame:
    """``features`` of ``cols`` Gamma draws for each row of ``keys``, seeded by its key."""

    @F.pandas_udf("array<double>")
    def draw(ids: pd.Series) -> pd.Series:
        # One counter-based generator, moved to the row's own counter.
        bits = np.random.Philox(key=seed)
        generator, state = np.random.Generator(bits), bits.state
        rows = []
        for i in ids.to_numpy():
            state["state"]["counter"][:] = (0, 0, 0, i)
            bits.state = state
            rows.append(generator.gamma(shape, scale, cols))
        return pd.Series(rows)

    return keys.withColumn("features", array_to_vector(draw(F.col(key).cast("bigint"))))


def gamma_matrix(spark: SparkSession, rows: int, cols: int, shape: float = 100.0,
                 scale: float = 0.01, seed: int = 11) -> DataFrame:
    """A ``rows`` x ``cols`` Gamma matrix, drawn on the executors."""
    return gamma_rows(spark.range(rows), "id", cols, shape, scale, seed)


def digit_message(key: Column, words: int, seed: int = 0) -> Column:
    """``words`` digits 0-9 joined by spaces, a pure function of key and seed."""
    start = F.pmod(key, F.lit(MODULUS))

    def digit(i: Column) -> Column:
        once = F.pmod(start * MULTIPLIER + i.cast("bigint") * INCREMENT + seed, F.lit(MODULUS))
        twice = F.pmod(once * MULTIPLIER + INCREMENT, F.lit(MODULUS))
        return F.pmod(F.shiftright(twice, 16), F.lit(10)).cast("string")

    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(words)), digit), " ")


def word_stream(spark: SparkSession, rows_per_second: int, words_per_message: int,
                seed: int = 0) -> DataFrame:
    """Endless digit messages at a steady rate: (value, timestamp)."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    return ticks.select(
        digit_message(F.col("value"), words_per_message, seed).alias("value"), "timestamp"
    )

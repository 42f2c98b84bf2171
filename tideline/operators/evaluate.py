"""Hold-out metrics of scored rows (label, prediction): one row, NULL when empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def accuracy(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"), _share(F.col("label") == F.col("prediction")).alias("accuracy")
    )


def error_rate(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"), _share(F.col("label") != F.col("prediction")).alias("error_rate")
    )


def mean_squared_error(scored: DataFrame) -> DataFrame:
    err = F.col("prediction") - F.col("label")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"))

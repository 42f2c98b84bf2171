"""File sources: text lines, LIBSVM, rating triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line of a file or folder as ``value STRING``."""
    return spark.read.text(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """(label, features). Naming the width saves the extra pass that infers it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def read_ratings(spark: SparkSession, path: str, boolean: bool = False) -> DataFrame:
    """``user,item,pref`` lines without header as (user_id, item_id, pref); blank lines are skipped.

    A missing or malformed field is an error. With ``boolean`` lines may also be
    ``user,item``, and every preference is 1.
    """
    fields = F.split(F.trim("value"), ",", -1)
    lines = spark.read.text(path).where(F.trim("value") != "").select(fields.alias("f"), F.size(fields).alias("n"))
    right = F.col("n").isin(2, 3) if boolean else F.col("n") == 3
    checked = F.when(right, F.col("f")).otherwise(
        F.raise_error(F.lit("a rating line must hold user, item and preference")).cast("array<string>"))
    rows = lines.select(checked.alias("f"))
    pref = F.lit(1.0) if boolean else F.trim(F.col("f")[2])
    return rows.select(F.trim(F.col("f")[0]).cast("bigint").alias("user_id"),
                       F.trim(F.col("f")[1]).cast("bigint").alias("item_id"), pref.cast("float").alias("pref"))

"""Text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tuple_line(*columns: str) -> Column:
    """``(a,b,...)`` of the named columns; a missing value prints as ``null``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.concat(F.lit("("), F.concat_ws(",", *texts), F.lit(")"))


def scored_tuple(df: DataFrame) -> DataFrame:
    """(id, prediction) widened to the output form ``0, id, prediction, 0``."""
    return df.select(
        F.lit(0).alias("head"), "id", "prediction", F.lit(0).alias("tail")
    )


def write_tuples(df: DataFrame, path: str) -> None:
    """One ``(a,b,...)`` per line in part files; an existing path is an error."""
    df.select(tuple_line(*df.columns).alias("value")).write.mode("errorifexists").text(path)


def write_recs(df: DataFrame, path: str) -> None:
    """``user<TAB>[item:score,...]``, best first. Each list is a top-k report, so short."""
    entries = F.array_sort(
        F.collect_list(F.struct("rank", "item_id", F.col("score").cast("float").alias("score")))
    )
    listed = F.transform(
        entries,
        lambda e: F.concat_ws(":", e["item_id"].cast("string"), e["score"].cast("string")),
    )
    lines = df.groupBy("user_id").agg(listed.alias("items")).select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("\t["), F.array_join("items", ","), F.lit("]")
        ).alias("value")
    )
    lines.write.mode("errorifexists").text(path)

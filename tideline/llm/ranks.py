"""Running sums within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.session import materialise

PART = "__part"


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with, for each entry of ``sums``, the sum over the rows of the group that come before.

    Rows are dealt by ranges of (group, order) and written; each piece of a group adds up its
    own rows, and the totals of the pieces before it are joined in. Rows alike in ``group``
    and ``order`` stay in one piece, so ``order`` should tell rows apart.
    """
    keys = [*group, *order]
    placed = materialise(
        df.withColumns({f"__{name}": value for name, value in sums.items()})
        .repartitionByRange(*keys).withColumn(PART, F.spark_partition_id()), "pieces")
    totals = placed.groupBy(PART, *group).agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sums])
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col(PART).alias("__p"), *[F.col(g).alias(f"__g_{g}") for g in group],
        *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__before_{n}") for n in sums])
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in group],
                  F.col(PART) == F.col("__p"))
    inside = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(before, same).select(
        *df.columns,
        *[(F.coalesce(F.sum(f"__{n}").over(inside), F.lit(0)) + F.col(f"__before_{n}")).alias(n) for n in sums])

"""Recommendations from user neighbourhoods and from item similarities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tideline.operators.prep import one_per_pair, to_boolean
from tideline.operators.similarity import (
    RANK_DIGITS, SIMILAR_ITEMS, neighbours, similar_of_seen,
)
from tideline.session import materialise

SLICE_USERS = 100_000  # users of an item that one slice of it holds, about
MOST_HOT = 10_000      # items that may be cut into slices; the size of a slice follows from it
FEW_SIMILAR = 1_000_000  # pairs of similar items that every task may hold
SEEN_PER_TASK = 50_000   # entries whose candidates one task adds up, about
MIN_NEIGHBOURS = 2  # an estimate resting on a single neighbour is not given


def users(ratings: DataFrame) -> DataFrame:
    """Every user once."""
    return ratings.select("user_id").distinct()


def _seen_marks(seen: DataFrame, *empty: str) -> DataFrame:
    """(user_id, item_id, NULLs, TRUE): rows that mark what a user already has."""
    blanks = [F.lit(None).cast("double").alias(name) for name in empty]
    return seen.select("user_id", "item_id", *blanks, F.lit(True).alias("seen"))


def estimate(ratings: DataFrame, neighbourhood: DataFrame,
             users: Sequence[int] | None = None) -> DataFrame:
    """(user_id, item_id, score, n): similarity-weighted mean of the neighbours' preferences.

    Items the user has rated are left out, and scores stay within the least and
    greatest preference of all ratings. ``users`` are those of the neighbourhood,
    when they are few. Rated items join in as marks, so that candidates are
    added up and sorted out in the same, pre-aggregated, shuffle. A user and item rated
    several times count once, with the mean preference.
    """
    ratings = one_per_pair(ratings)
    pref = F.col("pref").cast("double")
    theirs = ratings.select(F.col("user_id").alias("other_user_id"), "item_id", pref.alias("pref"))
    rated = ratings if users is None else ratings.where(F.col("user_id").isin(list(users)))
    candidates = (
        neighbourhood.select("user_id", "other_user_id", "sim")
        .join(theirs, "other_user_id")
        .select("user_id", "item_id", (F.col("sim") * F.col("pref")).alias("part"), "sim",
                F.lit(False).alias("seen"))
    )
    sums = (
        candidates.union(_seen_marks(rated, "part", "sim"))
        .groupBy("user_id", "item_id")
        .agg(
            F.sum("part").alias("weighted"), F.sum("sim").alias("weight"),
            F.count("sim").alias("n"), F.bool_or("seen").alias("seen"),
        )
        .where(~F.col("seen") & (F.col("n") >= MIN_NEIGHBOURS) & (F.col("weight") != 0))
    )
    bounds = ratings.agg(
        F.struct(F.min(pref).alias("low"), F.max(pref).alias("high")).alias("b")
    ).scalar()
    raw = F.col("weighted") / F.col("weight")
    return sums.select(
        "user_id", "item_id",
        F.least(F.greatest(raw, bounds["low"]), bounds["high"]).alias("score"), "n",
    )


def top_items(scored: DataFrame, k: int) -> DataFrame:
    """The k best items per user (user_id, item_id, score, rank); ties go to the lower id."""
    order = W.partitionBy("user_id").orderBy(F.round("score", RANK_DIGITS).desc(), F.col("item_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "user_id", "item_id", "score", "rank"
    )


def recommend_users(ratings: DataFrame, k: int = 3, metric: str = "euclidean", n: int | None = 2,
                    min_sim: float | None = None, users: Sequence[int] | None = None) -> DataFrame:
    """User-based top-k, for everyone or for the named ``users``.

    The neighbourhood is the ``n`` nearest users, or with ``n=None`` all whose
    similarity is at least ``min_sim``.
    """
    near = neighbours(ratings, metric, n=n, min_sim=min_sim, users=users)
    return top_items(estimate(ratings, near, users), k)


def hot_items(seen: DataFrame) -> DataFrame:
    """(item_id, slices) of items with too many users for one task; ``MOST_HOT`` rows at most.

    An item is hot above ``SLICE_USERS`` users, and above the ``MOST_HOT``-th part of all rows: no more
    than that many items can have so many.
    """
    counts = seen.groupBy("item_id").agg(F.count(F.lit(1)).alias("users"))
    total = seen.agg(F.count(F.lit(1))).scalar()
    room = F.greatest(F.lit(SLICE_USERS), F.ceil(total / MOST_HOT))
    return counts.where(F.col("users") > room).select("item_id", F.ceil(F.col("users") / room).cast("int").alias("slices"))


def _in_slices(rows: DataFrame, hot: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(hot), "item_id", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))


def sliced_join(seen: DataFrame, similar: DataFrame) -> DataFrame:
    """(user_id, item_id, other_item_id, sim, slice): each seen item with its similar ones.

    A hot item's users are dealt to slices, and its (few) similar items are copied to each.
    """
    hot = materialise(hot_items(seen), "hot-items")
    users = _in_slices(seen.select("user_id", "item_id"), hot).select(
        "user_id", "item_id", F.pmod(F.xxhash64("user_id"), "slices").cast("int").alias("slice"))
    others = _in_slices(similar.select("item_id", "other_item_id", "sim"), hot).select(
        "item_id", "other_item_id", "sim", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    return users.join(others, ["item_id", "slice"])


def item_scores(seen: DataFrame, similar: DataFrame) -> DataFrame:
    """(user_id, item_id, score): summed similarity of an unseen item to the user's items.

    ``seen`` holds each user and item together once. Where the similar items are few, candidates
    are added up where a user's entries are; else they are shuffled, added up per task before.
    """
    similar = materialise(similar.select("item_id", "other_item_id", "sim"), "similar")
    if similar.count() <= FEW_SIMILAR:
        return _scores_by_user(seen, similar)
    parts = sliced_join(seen, similar).select(
        "user_id", F.col("other_item_id").alias("item_id"), "sim", F.lit(False).alias("seen")
    )
    return (
        parts.union(_seen_marks(seen, "sim"))
        .groupBy("user_id", "item_id")
        .agg(F.sum("sim").alias("score"), F.bool_or("seen").alias("seen"))
        .where(~F.col("seen"))
        .drop("seen")
    )


def _scores_by_user(seen: DataFrame, similar: DataFrame) -> DataFrame:
    """:func:`item_scores` with the entries dealt by user, the only rows that are shuffled."""
    tasks = max(seen.sparkSession.sparkContext.defaultParallelism, -(-seen.count() // SEEN_PER_TASK))
    others = F.struct(F.col("other_item_id").alias("item_id"), "sim", F.lit(False).alias("seen"))
    lists = similar.groupBy("item_id").agg(F.collect_list(others).alias("others"))
    mark = F.array(F.struct("item_id", F.lit(None).cast("double").alias("sim"), F.lit(True).alias("seen")))
    dealt = seen.select("user_id", "item_id").repartition(tasks, "user_id").join(F.broadcast(lists), "item_id", "left")
    parts = dealt.select("user_id", F.inline(F.when(F.col("others").isNull(), mark).otherwise(F.concat(mark, "others"))))
    return (
        parts.groupBy("user_id", "item_id")
        .agg(F.sum("sim").alias("score"), F.bool_or("seen").alias("seen"))
        .where(~F.col("seen"))
        .drop("seen")
    )


def recommend_items(ratings: DataFrame, k: int = 10, similar_items: int = SIMILAR_ITEMS) -> DataFrame:
    """Item-based top-k for every user of boolean preferences."""
    seen = materialise(to_boolean(ratings).select("user_id", "item_id"), "seen")
    return top_items(item_scores(seen, similar_of_seen(seen, similar_items)), k)

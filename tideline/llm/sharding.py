"""Shards that all have the mixture of the whole: proportional stratified interleaving (operator 3).

Rows of a source are shuffled by a seeded hash and ranked; the fractional rank (rank - 1/2) /
rows orders the rows of all sources together, and this order is cut into shards of equal
numbers of rows. So each shard takes its share of every source, and counts differ by one at
most. Ranks are counted in buckets of the hash and of the fractional rank, so no task holds
a source.

A null source is a source of its own; rows of equal key keep the order of their checksum and
size; null texts count as empty. Groups of equal texts are not kept together: they are spread over
the shards as any other rows. An empty table gives no rows. Columns other than key, source and
text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tideline.session import materialise

OVERHEAD = 16  # bytes a row takes besides its text
BUCKET_DIGITS = 3  # hexadecimal digits of the hash: 4096 buckets of a source
BUCKETS = 16 ** BUCKET_DIGITS


def interleave(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", source: str = "source",
               text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = materialise(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"), shuffled.alias("h"),
    ).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)), "shard-rows")

    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("source")).alias("of_source"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("h", "key", "crc", "size")
    ranked = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "key", "source", "size", "crc", "of_source", (F.col("before") + F.row_number().over(in_bucket)).alias("rank"))
    fraction = (F.col("rank") - 0.5) / F.col("of_source")
    ordered = materialise(ranked.withColumn("fraction", fraction)
                          .withColumn("slice", F.floor(F.col("fraction") * BUCKETS).cast("int")), "shard-ranks")

    # One row for each of the BUCKETS slices at most.
    slices = ordered.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    places = slices.select(
        F.col("slice").alias("sl"),
        F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    in_slice = Window.partitionBy("slice").orderBy("fraction", F.col("source").asc_nulls_first(), "rank")
    placed = ordered.join(places, F.col("slice") == F.col("sl")).withColumn(
        "place", F.col("before") + F.row_number().over(in_slice) - 1)
    shard = F.expr(f"(place * {int(shards)}) div total")
    first = F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")  # rounded up
    return placed.withColumn("shard", shard).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"))

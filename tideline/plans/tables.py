"""The given tables, shaped into the inputs the operators take."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.session import materialise, shared_dir
from tideline.sources.streams import stream_table

# The category orders of the tables.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def index_of(column: str, values: list[str]) -> Column:
    """0-based place of a value in a fixed list."""
    return (F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)) - 1).cast("int")


def money(column: str) -> Column:
    """A price-like double as plain decimal text."""
    return F.col(column).cast("decimal(18,2)").cast("string")


# --- events as messages -------------------------------------------------------

def event_lines(events: DataFrame) -> DataFrame:
    """Each event as a line of words: (value, timestamp)."""
    return events.select(
        F.concat_ws(" ", "event_type", "props").alias("value"), F.col("ts").alias("timestamp")
    )


def event_numbers(events: DataFrame) -> DataFrame:
    """Each event's value as integer text: (value, timestamp)."""
    return events.select(
        F.floor("value").cast("string").alias("value"), F.col("ts").alias("timestamp")
    )


EVENT_FILES = 4
CLOSING = "closing"


def event_stream(spark: SparkSession, sf_dir: str, closing: Column | None = None) -> DataFrame:
    """The events as a stream of ``EVENT_FILES`` files in no order of time, a micro-batch each.

    Event time must be TIMESTAMP to carry a watermark. ``closing`` adds a last file
    with one event of type ``CLOSING`` at that time, an aggregate of the events' times.
    """
    path = shared_dir(spark, "event-files")
    events = table(spark, sf_dir, "events")
    events.repartition(EVENT_FILES, "event_id").write.parquet(path)
    if closing is not None:
        blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name not in ("ts", "event_type")]
        last = events.agg(closing.cast(events.schema["ts"].dataType).alias("ts")).select(
            "ts", F.lit(CLOSING).alias("event_type"), *blanks)
        last.select(events.columns).write.mode("append").parquet(path)
    return stream_table(spark, path, events.schema, max_files=1).withColumn("ts", F.col("ts").cast("timestamp"))


def event_span(spark: SparkSession, sf_dir: str) -> int:
    """Seconds from the first event to the last, rounded up."""
    seconds = F.unix_timestamp(F.max("ts").cast("timestamp")) - F.unix_timestamp(F.min("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").agg(seconds).first()[0] + 1


def lineitem_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/lineitem.parquet"
    return stream_table(spark, path, spark.read.parquet(path).schema)


# --- ratings --------------------------------------------------------------------

def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' mean event value per kind of event and hour of day, written once."""
    events = table(spark, sf_dir, "events")
    item = index_of("event_type", EVENT_TYPES) * 24 + F.hour("ts")
    derived = events.groupBy("user_id", item.cast("bigint").alias("item_id")).agg(
        F.round(F.avg("value"), 6).alias("pref")
    )
    return materialise(derived, "ratings")


# --- labelled rows ----------------------------------------------------------------

def _vector(*columns: Column) -> Column:
    return array_to_vector(F.array(*[c.cast("double") for c in columns]))


def nb_columns() -> dict[str, Column]:
    """Label and non-negative features for Naive Bayes."""
    return {
        "label": index_of("l_returnflag", RETURN_FLAGS).cast("double"),
        "f0": F.col("l_quantity"),
        "f1": F.round(F.col("l_extendedprice") / 1000, 6),
        "f2": F.round(F.col("l_discount") * 100, 6),
        "f3": F.round(F.col("l_tax") * 100, 6),
    }


def nb_rows(lineitem: DataFrame) -> DataFrame:
    c = nb_columns()
    return lineitem.select(
        "l_orderkey", "l_linenumber", c["label"].alias("label"),
        _vector(c["f0"], c["f1"], c["f2"], c["f3"]).alias("features"),
    )


def nb_lines(lineitem: DataFrame) -> DataFrame:
    """The same rows as ``label,f f f f`` text."""
    c = nb_columns()
    features = F.concat_ws(" ", *[c[f].cast("string") for f in ("f0", "f1", "f2", "f3")])
    return lineitem.select(F.concat_ws(",", c["label"].cast("string"), features).alias("value"))


def tree_rows(lineitem: DataFrame, label: Column) -> DataFrame:
    """(l_orderkey, label, features of quantity, discount and tax)."""
    return lineitem.select(
        "l_orderkey", label.cast("double").alias("label"),
        _vector(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")).alias("features"),
    )


def price_rows(lineitem: DataFrame) -> DataFrame:
    return tree_rows(lineitem, F.col("l_extendedprice"))


def status_index() -> Column:
    return index_of("l_linestatus", LINE_STATUSES)


def status_rows(lineitem: DataFrame) -> DataFrame:
    return tree_rows(lineitem, status_index())


def libsvm_lines(lineitem: DataFrame, label: Column | None = None) -> DataFrame:
    """``price 1:quantity 2:discount 3:tax``, or another label; zero features are left out, as LIBSVM does."""
    target = money("l_extendedprice") if label is None else label.cast("string")
    def item(place: int, column: str) -> Column:
        return F.when(F.col(column) != 0, F.concat(F.lit(f"{place}:"), money(column)))

    return lineitem.select(
        F.concat_ws(" ", target, item(1, "l_quantity"), item(2, "l_discount"),
                    item(3, "l_tax")).alias("value")
    )


def untidy_lines(lineitem: DataFrame, label: Column | None = None) -> DataFrame:
    """The LIBSVM lines with indents, double spaces, comments and blank lines mixed in."""
    text = F.col("value")
    variants = F.array(
        F.concat(F.lit("  "), text, F.lit("\t")),
        F.concat(F.lit("# "), text),
        F.lit("   "),
        F.regexp_replace(text, " 2:", "  2:"),
    )
    return libsvm_lines(lineitem, label).select(F.explode(variants).alias("value"))


FLIGHT_WIDTH = 9
# Declared number of categories of slots 6, 7 and 8, and the bins.
FLIGHT_ARITIES = {6: 19, 7: 285, 8: 285}
FLIGHT_BINS = 286


def flight_columns() -> list[Column]:
    """Nine feature slots, the last three categorical."""
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return [
        F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.col("l_linenumber"),
        F.col("p_size"), F.year("l_shipdate"),
        index_of("l_returnflag", RETURN_FLAGS), F.col("s_nationkey"), brand,
    ]


def flight_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the part and supplier columns the nine slots are made of."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed and labelled rows (id, label, features), joined and written once.

    The passes of a fit and the scoring read them instead of joining again.
    """
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = flight_table(spark, sf_dir).select(
        key.alias("id"), F.col("l_extendedprice").alias("label"), _vector(*flight_columns()).alias("features")
    )
    return materialise(rows, "flights")


def flight_lines(rows: DataFrame) -> DataFrame:
    """Keyed rows as ``id,f0,...,f8`` text."""
    slots = F.transform(vector_to_array("features"), lambda v: v.cast("string"))
    return rows.select(F.concat_ws(",", F.col("id"), slots).alias("value"))


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def written_lines(lines: DataFrame, purpose: str) -> str:
    """Write ``value`` lines to a fresh folder of text files; returns the folder."""
    path = shared_dir(lines.sparkSession, purpose)
    lines.select("value").write.text(path)
    return path

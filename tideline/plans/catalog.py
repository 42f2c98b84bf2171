"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.functions import parsing as P
from tideline.operators import aggregates as A
from tideline.operators import evaluate as E
from tideline.operators import matrix as X
from tideline.operators import models as M
from tideline.operators import prep
from tideline.operators import recommend as R
from tideline.operators import similarity as S
from tideline.plans import tables as T
from tideline.session import materialise, shared_dir
from tideline.sinks import text as sinks
from tideline.sources import files, streams
from tideline.streaming import intervals, retained, runtime, scoring, stored, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
EXACT_BINS = 64  # more than the distinct values of any tree feature: all cuts are tried
HOUR = "1 hour"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(name: str, digits: int = DIGITS) -> Column:
    return F.round(F.col(name), digits).alias(name)


def _slots(df: DataFrame, width: int, *kept: str) -> DataFrame:
    """Unpack a feature vector into columns f0, f1, ..."""
    values = vector_to_array("features")
    return df.select(*kept, *[values[i].alias(f"f{i}") for i in range(width)])


def _clock(df: DataFrame) -> DataFrame:
    """Window bounds as text."""
    for name in ("window_start", "window_end"):
        df = df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))
    return df


# --- sources and sinks ----------------------------------------------------------

@query
def s01_text_scan(spark, sf_dir):
    lines = T.nb_lines(T.table(spark, sf_dir, "lineitem"))
    return files.read_lines(spark, T.written_lines(lines, "s01"))


@query
def s02_libsvm_scan(spark, sf_dir):
    lines = T.libsvm_lines(T.table(spark, sf_dir, "lineitem"))
    rows = files.read_libsvm(spark, T.written_lines(lines, "s02"), num_features=3)
    return _slots(rows, 3, "label")


@query
def s03_ratings_scan(spark, sf_dir):
    rating = F.concat_ws(",", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                         F.col("pref").cast("string"))
    # Every second line is blank, as rating files may have it.
    lines = T.ratings(spark, sf_dir).select(F.explode(F.array(rating, F.lit(""))).alias("value"))
    rows = files.read_ratings(spark, T.written_lines(lines, "s03"))
    return rows.withColumn("pref", F.round(F.col("pref").cast("double"), 3))


@query
def s04_stream_lines(spark, sf_dir):
    landing = T.written_lines(T.event_lines(T.table(spark, sf_dir, "events")), "landing")
    lines = streams.stream_lines(spark, "files", path=landing)
    return runtime.drain_appends(lines, "s04").select("value")


@query
def k01_tuple_text(spark, sf_dir):
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    scored = T.table(spark, sf_dir, "lineitem").select(
        key.alias("id"), F.col("l_quantity").alias("prediction"))
    path = shared_dir(spark, "k01")
    sinks.write_tuples(sinks.scored_tuple(scored), path)
    return files.read_lines(spark, path)


@query
def k05_recs_text(spark, sf_dir):
    path = shared_dir(spark, "k05")
    sinks.write_recs(R.recommend_items(T.ratings(spark, sf_dir)), path)
    halves = F.split(F.col("value"), "\t")
    listed = F.split(F.regexp_replace(halves[1], r"[\[\]]", ""), ",")
    entries = files.read_lines(spark, path).select(
        halves[0].cast("bigint").alias("user_id"), F.posexplode(listed).alias("pos", "entry"))
    entry = F.split("entry", ":")
    return entries.select(
        "user_id", (F.col("pos") + 1).alias("rank"), entry[0].cast("bigint").alias("item_id"),
        F.round(entry[1].cast("float").cast("double"), 4).alias("score"))


# --- parsing and preparation ------------------------------------------------------

def _csv_lines(spark, sf_dir, *leading: Column) -> DataFrame:
    numbers = [T.money(c) for c in ("l_quantity", "l_discount", "l_tax")]
    # The trailing comma is an empty field that does not count.
    line = F.concat(F.concat_ws(",", *leading, *numbers), F.lit(","))
    return T.table(spark, sf_dir, "lineitem").select(line.alias("value"))


@query
def p01_parse_label_csv(spark, sf_dir):
    lines = _csv_lines(spark, sf_dir, T.money("l_extendedprice"))
    return _slots(P.parse_label_csv(lines), 3, "label")


@query
def p02_parse_label_space(spark, sf_dir):
    return _slots(P.parse_label_space(T.nb_lines(T.table(spark, sf_dir, "lineitem"))), 4, "label")


@query
def p03_parse_keyed_csv(spark, sf_dir):
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return _slots(P.parse_keyed_csv(_csv_lines(spark, sf_dir, key)), 3, "id")


def _parsed_libsvm(spark, sf_dir):
    lines = T.untidy_lines(T.table(spark, sf_dir, "lineitem"))
    return P.parse_libsvm(P.clean_lines(lines))


@query
def p04_parse_libsvm(spark, sf_dir):
    return _parsed_libsvm(spark, sf_dir).select(
        "label",
        F.array_join(F.col("indices").cast("array<string>"), " ").alias("indices"),
        F.array_join(F.col("values").cast("array<string>"), " ").alias("feature_values"),
        F.size("values").alias("n_values"),
    )


@query
def p05_clean_lines(spark, sf_dir):
    return P.clean_lines(T.untidy_lines(T.table(spark, sf_dir, "lineitem")))


@query
def p06_infer_width(spark, sf_dir):
    return P.infer_width(_parsed_libsvm(spark, sf_dir))


@query
def p07_sparse_assemble(spark, sf_dir):
    return _slots(P.to_vector(_parsed_libsvm(spark, sf_dir), 5), 5, "label")


@query
def p07_sparse_assemble_wide(spark, sf_dir):
    return _slots(P.to_vector(_parsed_libsvm(spark, sf_dir), 40), 40, "label")


@query
def p08_parse_int(spark, sf_dir):
    text = F.explode(F.array(F.floor("value").cast("string"), F.col("event_type"), F.lit(" 7")))
    messages = T.table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return P.parse_int(messages, strict=False)


@query
def p09_tokenize(spark, sf_dir):
    line = F.concat_ws("  ", "event_type", "props")
    padded = F.when(F.col("event_type") == "view", F.concat(line, F.lit("  "))).otherwise(line)
    return P.tokenize(T.table(spark, sf_dir, "events").select("event_id", padded.alias("value")))


@query
def p14_hash_split(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey")
    parts = prep.split_hash(orders, "o_orderkey", [0.6, 0.3, 0.1], salt=11)
    marked = [part.withColumn("part", F.lit(i)) for i, part in enumerate(parts)]
    return marked[0].union(marked[1]).union(marked[2])


# --- aggregates and windows -----------------------------------------------------

def _numbers(events: DataFrame) -> DataFrame:
    return P.parse_int(T.event_numbers(events))


def _words(events: DataFrame) -> DataFrame:
    return P.tokenize(T.event_lines(events))


@query
def a01_int_average(spark, sf_dir):
    result = A.int_average(_numbers(T.table(spark, sf_dir, "events")))
    return result.withColumn("avg", _rounded("avg"))


@query
def a06_word_count(spark, sf_dir):
    return A.word_count(_words(T.table(spark, sf_dir, "events")))


@query
def a07_batch_counts(spark, sf_dir):
    lines = T.event_lines(T.table(spark, sf_dir, "events"))
    return _clock(windows.batch_counts(lines, "10 minutes"))


@query
def a07s_counts_stream(spark, sf_dir):
    counts = windows.batch_counts(T.event_lines(T.event_stream(spark, sf_dir)), "10 minutes")
    return _clock(runtime.drain_updates(counts, ["window_start", "window_end"], "a07s"))


@query
def w01_batch_average(spark, sf_dir):
    result = windows.streaming_average(_numbers(T.table(spark, sf_dir, "events")), "10 minutes")
    return _clock(result.withColumn("avg", _rounded("avg")))


@query
def w01s_average_stream(spark, sf_dir):
    averages = windows.streaming_average(_numbers(T.event_stream(spark, sf_dir)), HOUR)
    latest = runtime.drain_updates(averages, ["window_start", "window_end"], "w01s")
    return _clock(latest.withColumn("avg", _rounded("avg")))


def _until(length: str, last: Column, lateness: int) -> Column:
    """When a closing event brings the watermark just past ``length`` after the last pane's start."""
    return last + F.expr(f"INTERVAL {length}") + F.make_interval(secs=F.lit(lateness + 1))


@query
def w01s_intervals_stream(spark, sf_dir):
    # The replay is bounded, as below; the closing event has no number.
    lateness = T.event_span(spark, sf_dir)
    last = F.timestamp_seconds((F.unix_timestamp(F.max("ts").cast("timestamp")) / 600).cast("bigint") * 600)
    own = retained.retained_session(spark)
    events = T.event_stream(own, sf_dir, _until("10 minutes", last, lateness))
    numbers = events.select(
        F.when(F.col("event_type") != T.CLOSING, F.floor("value")).cast("int").alias("number"),
        F.col("ts").alias("timestamp"))
    averages = intervals.streaming_average_reported(numbers, f"{lateness} seconds", "10 minutes")
    return _clock(runtime.drain_appends(averages, "w01s-intervals").withColumn("avg", _rounded("avg")))


@query
def w02_sliding_words(spark, sf_dir):
    return _clock(windows.sliding_word_count(_words(T.table(spark, sf_dir, "events"))))


@query
def w02_zero_retained(spark, sf_dir):
    words = _words(T.table(spark, sf_dir, "events"))
    return _clock(windows.sliding_word_count(words, "12 hours", HOUR, keep_expired=True))


@query
def w02s_words_stream(spark, sf_dir):
    counts = windows.sliding_word_count(_words(T.event_stream(spark, sf_dir)), "12 hours", HOUR)
    return _clock(runtime.drain_updates(counts, ["window_start", "window_end", "word"], "w02s"))


@query
def w02z_retained_stream(spark, sf_dir):
    # The replay is bounded: no event is later than the whole span, and a closing event
    # brings the watermark to the end of the last window.
    lateness = T.event_span(spark, sf_dir)
    closing = _until("12 hours", F.date_trunc("hour", F.max("ts")), lateness)
    own = retained.retained_session(spark)
    words = _words(T.event_stream(own, sf_dir, closing))
    counts = retained.sliding_word_count_retained(words, f"{lateness} seconds", "12 hours", HOUR)
    return _clock(runtime.drain_appends(counts, "w02z")).where(F.col("word") != T.CLOSING)


@query
def w02s_panes_stream(spark, sf_dir):
    lateness = T.event_span(spark, sf_dir)
    own = retained.retained_session(spark)
    words = _words(T.event_stream(own, sf_dir, _until("2 minutes", F.max("ts"), lateness)))
    counts = retained.sliding_word_count_retained(words, f"{lateness} seconds", keep_expired=False)
    return _clock(runtime.drain_appends(counts, "w02s-panes")).where(F.col("word") != T.CLOSING)


# --- models -----------------------------------------------------------------------

def _lineitem(spark, sf_dir):
    return T.table(spark, sf_dir, "lineitem")


@query
def m01_nb_model(spark, sf_dir):
    model = M.train_nb(T.nb_rows(_lineitem(spark, sf_dir)))
    return M.nb_parameters(spark, model).select(
        "label", "feature", _rounded("log_prior"), _rounded("log_prob"))


@query
def m06_nb_score(spark, sf_dir):
    rows = T.nb_rows(_lineitem(spark, sf_dir))
    return M.score(M.train_nb(rows), rows)


@query
def m08_nb_stream(spark, sf_dir):
    model = M.train_nb(T.nb_rows(_lineitem(spark, sf_dir)))
    lines = T.nb_lines(T.lineitem_stream(spark, sf_dir))
    scored = runtime.drain_appends(scoring.score_stream(model, lines, "label_space"), "m08")
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query
def m08_stored_model(spark, sf_dir):
    # Trained and stored here, loaded and applied in another session.
    store, out = shared_dir(spark, "m08-store"), shared_dir(spark, "m08-scored")
    stored.store_model(spark, M.train_nb(T.nb_rows(_lineitem(spark, sf_dir))), "label_space", store)
    lines = T.nb_lines(T.lineitem_stream(spark.newSession(), sf_dir))
    stored.score_with_latest(lines, store, out, shared_dir(spark, "m08-checkpoint"))
    return spark.read.parquet(out).groupBy("label", "prediction", "model_version").agg(F.count(F.lit(1)).alias("n"))


def _status_tree(rows, depth=5):
    return M.train_tree(rows, "classifier", max_depth=depth, max_bins=EXACT_BINS)


def _price_tree(rows, depth=5):
    return M.train_tree(rows, "regressor", max_depth=depth, max_bins=EXACT_BINS)


def _root(spark, model):
    return M.describe_tree(spark, model).where(F.col("node") == 0).select(
        "feature", _rounded("threshold"), "n")


@query
def m02_tree_classifier(spark, sf_dir):
    rows = T.status_rows(_lineitem(spark, sf_dir))
    scored = M.score(_status_tree(rows), rows)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query
def m02_root_split(spark, sf_dir):
    return _root(spark, _status_tree(T.status_rows(_lineitem(spark, sf_dir)), depth=1))


@query
def m03_tree_regressor(spark, sf_dir):
    rows = T.price_rows(_lineitem(spark, sf_dir))
    scored = M.score(_price_tree(rows), rows)
    return scored.groupBy(F.round("prediction", 4).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def m03_root_split(spark, sf_dir):
    return _root(spark, _price_tree(T.price_rows(_lineitem(spark, sf_dir)), depth=1))


def _flight_tree(rows):
    return M.train_tree(rows, "regressor", max_bins=T.FLIGHT_BINS,
                        categoricals=T.FLIGHT_ARITIES, width=T.FLIGHT_WIDTH)


@query
def m04_tree_categorical(spark, sf_dir):
    nodes = M.describe_tree(spark, _flight_tree(T.flight_rows(spark, sf_dir).drop("id")))
    return nodes.select("feature", "n", _rounded("prediction", 4))


@query
def m05_tree_nodes(spark, sf_dir):
    nodes = M.describe_tree(spark, _price_tree(T.price_rows(_lineitem(spark, sf_dir))))
    return nodes.select("feature", _rounded("threshold"), "n", _rounded("prediction", 4))


@query
def m07_keyed_score(spark, sf_dir):
    rows = T.flight_rows(spark, sf_dir)
    scored = M.score(_flight_tree(rows.drop("id")), rows.drop("label"))
    return scored.select("id", _rounded("prediction", 4))


@query
def m09_tree_stream(spark, sf_dir):
    model = _price_tree(T.price_rows(_lineitem(spark, sf_dir)))
    lines = T.untidy_lines(T.lineitem_stream(spark, sf_dir))
    scored = runtime.drain_appends(scoring.score_stream(model, lines, "libsvm"), "m09")
    return scored.groupBy(F.round("prediction", 4).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def m09_classifier_stream(spark, sf_dir):
    model = _status_tree(T.status_rows(_lineitem(spark, sf_dir)))
    lines = T.untidy_lines(T.lineitem_stream(spark, sf_dir), T.status_index())
    scored = runtime.drain_appends(scoring.score_stream(model, lines, "libsvm"), "m09-classifier")
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query
def m09_keyed_stream(spark, sf_dir):
    rows = T.flight_rows(spark, sf_dir)
    model = _flight_tree(rows.drop("id"))
    lines = streams.stream_lines(spark, path=T.written_lines(T.flight_lines(rows), "flight-lines"))
    scored = runtime.drain_appends(scoring.score_stream(model, lines, "keyed_csv"), "m09-keyed")
    return scored.select("id", _rounded("prediction", 4))


@query
def m10_pca(spark, sf_dir):
    return X.pca(T.embedding_rows(spark, sf_dir), 10).select(
        "component", "feature", (F.round("loading", 6) + F.lit(0.0)).alias("loading"), _rounded("explained"))


@query
def m11_covariance(spark, sf_dir):
    return X.covariance(T.embedding_rows(spark, sf_dir)).select("i", "j", _rounded("cov"))


# --- hold-out metrics -------------------------------------------------------------

@query
def e01_accuracy(spark, sf_dir):
    rows = T.nb_rows(_lineitem(spark, sf_dir))
    train, test = prep.split_hash(rows, "l_orderkey", [0.6, 0.4])
    return E.accuracy(M.score(M.train_nb(train), test)).select("n", _rounded("accuracy"))


@query
def e02_error_rate(spark, sf_dir):
    rows = T.status_rows(_lineitem(spark, sf_dir))
    train, test = prep.split_hash(rows, "l_orderkey", [0.7, 0.3])
    return E.error_rate(M.score(_status_tree(train), test)).select("n", _rounded("error_rate"))


@query
def e03_mse(spark, sf_dir):
    rows = T.price_rows(_lineitem(spark, sf_dir))
    train, test = prep.split_hash(rows, "l_orderkey", [0.8, 0.2])
    return E.mean_squared_error(M.score(_price_tree(train), test)).select("n", _rounded("mse", 2))


# --- recommendations --------------------------------------------------------------

def _profile(ratings, metric):
    profile = S.user_similarity_profile(ratings, metric)
    return profile.select(
        "user_id", "n_similar", _rounded("mean_sim"), _rounded("min_sim"), _rounded("max_sim"))


@query
def c01_pearson(spark, sf_dir):
    # Every pair, beside the profile of its first user. The pairs grow with the square of the
    # users and are never shuffled; the profiles, a row per user, are sent to them.
    ratings = T.ratings(spark, sf_dir)
    profile = materialise(_profile(ratings, "pearson"), "profile")
    pairs = S.user_similarity(ratings, "pearson").withColumn("sim", _rounded("sim"))
    return pairs.join(F.broadcast(profile), "user_id")


@query
def c02_euclidean(spark, sf_dir):
    return _profile(T.ratings(spark, sf_dir), "euclidean")


@query
def c03_threshold(spark, sf_dir):
    near = S.neighbours(T.ratings(spark, sf_dir), "pearson", min_sim=0.1)
    return near.withColumn("sim", _rounded("sim"))


@query
def c03_threshold_profile(spark, sf_dir):
    profile = S.user_similarity_profile(T.ratings(spark, sf_dir), "pearson", min_sim=0.1)
    return profile.select("user_id", "n_similar", _rounded("mean_sim"), _rounded("min_sim"), _rounded("max_sim"))


@query
def c04_nearest_n(spark, sf_dir):
    near = S.neighbours(T.ratings(spark, sf_dir), "euclidean", n=2)
    return near.withColumn("sim", _rounded("sim"))


@query
def c05_estimate(spark, sf_dir):
    ratings = T.ratings(spark, sf_dir)
    scores = R.estimate(ratings, S.neighbours(ratings, "euclidean", n=2))
    return scores.withColumn("score", F.round("score", 5))


@query
def c06_user_recs(spark, sf_dir):
    recs = R.recommend_users(T.ratings(spark, sf_dir), k=3, metric="euclidean", n=2)
    return recs.withColumn("score", F.round("score", 5))


@query
def c06_one_user(spark, sf_dir):
    # The request is for one user's items; everyone's ratings take part.
    recs = R.recommend_users(
        T.ratings(spark, sf_dir), k=3, metric="pearson", n=None, min_sim=0.1, users=[2])
    return recs.withColumn("score", F.round("score", 5))


@query
def c07_item_similarity(spark, sf_dir):
    return S.item_similarity(T.ratings(spark, sf_dir)).withColumn("sim", _rounded("sim"))


@query
def c08_item_recs(spark, sf_dir):
    recs = R.recommend_items(T.ratings(spark, sf_dir))
    return recs.withColumn("score", F.round("score", 5))


@query
def c09_users(spark, sf_dir):
    return R.users(T.table(spark, sf_dir, "events"))

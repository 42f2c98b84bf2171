"""Whole programs, put together from the operators.

Batch programs return what they computed as DataFrames; streaming programs
return the running query. Streams are given as DataFrames of
(value, timestamp), from :func:`tideline.sources.streams.stream_lines`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.base import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.parsing import (
    parse_int, parse_keyed_csv, parse_label_csv, parse_label_space, tokenize,
)
from tideline.operators import evaluate, models
from tideline.operators.matrix import pca
from tideline.operators.prep import persisted, split_random
from tideline.operators.recommend import recommend_items, recommend_users
from tideline.sinks.messages import console_sink, write_kafka
from tideline.sinks.text import scored_tuple, write_recs, write_tuples
from tideline.sources.files import read_libsvm, read_lines, read_ratings
from tideline.sources.synthetic import gamma_matrix, word_stream
from tideline.streaming.retained import sliding_word_count_retained
from tideline.streaming.runtime import start_query
from tideline.streaming.scoring import score_stream
from tideline.streaming.windows import batch_counts, sliding_word_count, streaming_average

# The programs' own settings.
SPLIT_SEED = 11
NB_SPLIT = (0.6, 0.4)
TREE_SPLIT = (0.7, 0.3)
FLIGHT_SPLIT = (0.8, 0.2)
FLIGHT_ARITIES = {6: 19, 7: 285, 8: 285}
FLIGHT_BINS = 286
COMPONENTS = 10
MATRIX_SIZE = 2000


@dataclass
class Trained:
    """A model, its hold-out metric (one row) and its scored hold-out rows."""

    model: Model
    metric: DataFrame
    scored: DataFrame


# --- batch ------------------------------------------------------------------------

def naive_bayes(spark: SparkSession, path: str, out: str | None = None,
                seed: int = SPLIT_SEED) -> Trained:
    """Train on 60 %, report accuracy on the rest, write (prediction,label) pairs."""
    rows = parse_label_space(read_lines(spark, path))
    train, test = split_random(rows, NB_SPLIT, seed)
    model = models.train_nb(train)
    scored = models.score(model, test)
    if out:
        write_tuples(scored.select("prediction", "label"), out)
    return Trained(model, evaluate.accuracy(scored), scored)


def decision_tree(spark: SparkSession, path: str, kind: str, num_features: int | None = None,
                  seed: int = SPLIT_SEED) -> Trained:
    """Train on 70 % of a LIBSVM file; error rate (classifier) or MSE (regressor) on the rest."""
    train, test = split_random(read_libsvm(spark, path, num_features), TREE_SPLIT, seed)
    with persisted(train) as kept:
        model = models.train_tree(kept, kind)
    scored = models.score(model, test)
    metric = evaluate.error_rate if kind == "classifier" else evaluate.mean_squared_error
    return Trained(model, metric(scored), scored)


def flight_delays(spark: SparkSession, history: str, width: int, scheduled: str | None = None,
                  out: str | None = None, categoricals: Mapping[int, int] = FLIGHT_ARITIES,
                  max_bins: int = FLIGHT_BINS, seed: int = SPLIT_SEED) -> Trained:
    """Regression tree with categorical slots; scores a schedule to ``(0,id,prediction,0)`` lines.

    ``width`` is the number of features of a line, needed to declare the slots.
    """
    rows = parse_label_csv(read_lines(spark, history))
    train, test = split_random(rows, FLIGHT_SPLIT, seed)
    with persisted(train) as kept:
        model = models.train_tree(kept, "regressor", max_bins=max_bins,
                                  categoricals=categoricals, width=width)
    scored = models.score(model, test)
    if scheduled and out:
        flights = parse_keyed_csv(read_lines(spark, scheduled))
        write_tuples(scored_tuple(models.score(model, flights)), out)
    return Trained(model, evaluate.mean_squared_error(scored), scored)


def principal_components(spark: SparkSession, size: int = MATRIX_SIZE, k: int = COMPONENTS,
                         seed: int = SPLIT_SEED) -> DataFrame:
    """Top components of a size x size Gamma matrix."""
    return pca(gamma_matrix(spark, size, size, seed=seed), k)


def recommend_for_user(spark: SparkSession, path: str, user: int = 2, k: int = 3) -> DataFrame:
    """Pearson similarity, neighbours from 0.1 on, one user."""
    ratings = read_ratings(spark, path)
    return recommend_users(ratings, k, "pearson", n=None, min_sim=0.1, users=[user])


def recommend_for_all(spark: SparkSession, path: str, k: int = 3, n: int = 2) -> DataFrame:
    """Euclidean similarity, the n nearest, every user."""
    return recommend_users(read_ratings(spark, path), k, "euclidean", n=n)


def recommend_by_items(spark: SparkSession, path: str, out: str | None = None, k: int = 10) -> DataFrame:
    """Item-based on boolean preferences; written as one line per user."""
    recs = recommend_items(read_ratings(spark, path), k)
    if out:
        write_recs(recs, out)
    return recs


# --- streams ----------------------------------------------------------------------

def average_messages(lines: DataFrame, checkpoint: str, interval: str = "10 seconds",
                     trigger: str | None = "10 seconds", wait: bool = True) -> StreamingQuery:
    """Integer average per interval, printed."""
    averages = streaming_average(parse_int(lines), interval)
    return start_query(console_sink(averages, mode="update"), checkpoint, trigger, wait=wait)


def count_words(lines: DataFrame, checkpoint: str, window: str = "2 minutes",
                slide: str = "10 seconds", keep_expired: bool = True, lateness: str | None = None,
                trigger: str | None = "10 seconds", wait: bool = True) -> StreamingQuery:
    """Sliding word counts, printed; ``keep_expired`` goes on reporting vanished words as 0.

    That needs a ``lateness``, beyond which rows are dropped, and lines read in a
    :func:`tideline.streaming.retained.retained_session`.
    """
    words = tokenize(lines)
    if keep_expired:
        if lateness is None:
            raise ValueError("keep_expired needs a lateness")
        writer = console_sink(sliding_word_count_retained(words, lateness, window, slide))
    else:
        writer = console_sink(sliding_word_count(words, window, slide), mode="update")
    return start_query(writer, checkpoint, trigger, wait=wait)


def produce_words(spark: SparkSession, servers: str, topic: str, checkpoint: str,
                  messages_per_second: int, words_per_message: int) -> StreamingQuery:
    """Random digit messages to a Kafka topic."""
    return write_kafka(word_stream(spark, messages_per_second, words_per_message),
                       servers, topic, checkpoint=checkpoint)


def score_messages(model: Model, lines: DataFrame, form: str, checkpoint: str,
                   trigger: str | None = "2 seconds", wait: bool = True,
                   echo: str | None = None) -> StreamingQuery:
    """Score a stream with a trained model, printed.

    ``form`` is ``label_space`` for Naive Bayes, ``libsvm`` for the trees and
    ``keyed_csv`` for flights. ``echo``, a second checkpoint folder, also prints
    the incoming lines.
    """
    if echo:
        start_query(console_sink(lines), echo, trigger, wait=False)
    return start_query(console_sink(score_stream(model, lines, form)), checkpoint, trigger, wait=wait)


def count_events(lines: DataFrame, checkpoint: str, interval: str = "2 seconds",
                 trigger: str | None = "2 seconds", wait: bool = True) -> StreamingQuery:
    """Number of events per interval, printed."""
    return start_query(console_sink(batch_counts(lines, interval), mode="update"),
                       checkpoint, trigger, wait=wait)

"""Models kept with what is needed to use them, and exchanged under a running stream.

A store is a folder of numbered versions. A version holds the model and, written last, a card with
the form of the lines it scores and the width of its vectors: a version without a card is not
there yet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.base import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.streaming.runtime import for_each_batch, start_query
from tideline.streaming.scoring import FORMS, score_stream

CARD = "version INT, form STRING, width INT"


@dataclass(frozen=True)
class StoredModel:
    model: Model
    form: str
    version: int


def _cards(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.schema(CARD).parquet(f"{store}/v*/card")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_version(spark: SparkSession, store: str) -> int:
    """The newest complete version; 0 if there is none."""
    cards = _cards(spark, store)
    return (cards.agg(F.max("version")).first()[0] or 0) if cards is not None else 0


def store_model(spark: SparkSession, model: Model, form: str, store: str) -> int:
    """Add a version for lines of ``form``; of two writers at once, one fails."""
    if form not in FORMS:
        raise ValueError(f"unknown line form: {form}")
    version = latest_version(spark, store) + 1
    model.write().save(f"{store}/v{version}/model")
    card = spark.createDataFrame([(version, form, model.numFeatures)], CARD)
    card.coalesce(1).write.parquet(f"{store}/v{version}/card")
    return version


def load_model(spark: SparkSession, store: str, version: int | None = None) -> StoredModel:
    """A version of a store, else the newest."""
    version = version or latest_version(spark, store)
    if not version:
        raise ValueError(f"no model is stored in {store}")
    card = spark.read.schema(CARD).parquet(f"{store}/v{version}/card").first()
    model = DefaultParamsReader.loadParamsInstance(f"{store}/v{version}/model", spark)
    if model.numFeatures != card["width"]:
        raise ValueError(f"version {version} takes {model.numFeatures} features, its card says {card['width']}")
    return StoredModel(model, card["form"], version)


def score_with_latest(lines: DataFrame, store: str, out: str, checkpoint: str, interval: str | None = None,
                      wait: bool = True) -> StreamingQuery:
    """Score a stream, each micro-batch with the newest model stored when it begins.

    Rows are written to ``out`` with the ``model_version`` that scored them, a folder per batch, which a
    batch that is run again overwrites. The model is read again only when there is a newer one.
    """
    spark = lines.sparkSession
    held: dict[str, StoredModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        version = latest_version(spark, store)
        if "model" not in held or held["model"].version != version:
            held["model"] = load_model(spark, store, version)
        now = held["model"]
        scored = score_stream(now.model, batch, now.form).withColumn("model_version", F.lit(now.version))
        scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return start_query(for_each_batch(lines, write), checkpoint, interval, wait=wait)

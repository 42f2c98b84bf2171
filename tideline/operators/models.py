"""Naive Bayes and decision trees: train, describe, score."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.base import Model
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, NaiveBayesModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.operators.prep import with_categoricals
from tideline.session import shared_dir


def train_nb(df: DataFrame, smoothing: float = 1.0) -> NaiveBayesModel:
    """Multinomial Naive Bayes on (label, features >= 0)."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(df)


def nb_parameters(spark: SparkSession, model: NaiveBayesModel) -> DataFrame:
    """The model as rows (label, feature, log_prior, log_prob): classes x features."""
    priors, theta = model.pi.toArray(), model.theta.toArray()
    rows = [
        (float(c), f, float(priors[c]), float(theta[c, f]))
        for c in range(theta.shape[0]) for f in range(theta.shape[1])
    ]
    return spark.createDataFrame(
        rows, "label DOUBLE, feature INT, log_prior DOUBLE, log_prob DOUBLE"
    )


def train_tree(df: DataFrame, kind: str = "regressor", max_depth: int = 5, max_bins: int = 32,
               categoricals: Mapping[int, int] | None = None, width: int | None = None,
               seed: int = 11) -> Model:
    """A decision tree on (label, features): gini for classes, variance for values.

    ``categoricals`` maps slots to their number of values (``width`` is the vector
    length); ``max_bins`` must be at least the largest of them.
    """
    if categoricals:
        if width is None:
            raise ValueError("width is needed to declare categorical slots")
        if max_bins < max(categoricals.values()):
            raise ValueError("max_bins is below the largest number of categories")
        df = with_categoricals(df, categoricals, width)
    settings = dict(maxDepth=max_depth, maxBins=max_bins, seed=seed)
    if kind == "classifier":
        return DecisionTreeClassifier(impurity="gini", **settings).fit(df)
    if kind == "regressor":
        return DecisionTreeRegressor(impurity="variance", **settings).fit(df)
    raise ValueError(f"unknown kind of tree: {kind}")


def describe_tree(spark: SparkSession, model: Model) -> DataFrame:
    """The tree's nodes, as the model's own saved node table.

    ``feature`` and ``threshold`` are NULL for a leaf; a categorical split has
    ``left_categories`` instead of a threshold.
    """
    path = shared_dir(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    inner = F.col("leftChild") >= 0
    continuous = inner & (F.col("split.numCategories") < 0)
    values = F.col("split.leftCategoriesOrThreshold")
    return nodes.select(
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left_node"),
        F.when(inner, F.col("rightChild")).alias("right_node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(continuous, F.try_element_at(values, F.lit(1))).alias("threshold"),
        F.when(inner & ~continuous, values).alias("left_categories"),
        F.col("prediction"),
        F.col("impurity"),
        F.col("rawCount").cast("bigint").alias("n"),
    )


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction``; the feature vector and the model's scratch columns go."""
    kept = [c for c in df.columns if c != "features"]
    return model.transform(df).select(*kept, "prediction")

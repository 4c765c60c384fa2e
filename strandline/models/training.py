"""Weighted binary classifiers as MLlib pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.models.features import FEATURES, complete, feature_names, feature_stages
from strandline.operators.joins import join_checked
from strandline.operators.split import class_weights
from strandline.session import keep

WEIGHT = "class_weight"
LABEL = "label"


def weighted(train: DataFrame, target: str, numeric: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows to fit to, with a double label and balanced class weights, and their number.

    These are the rows that have a label and all their numbers.
    """
    usable = train.where(F.col(target).isNotNull() & complete(numeric))
    weights = keep(class_weights(usable, target))
    n = weights.agg(F.sum("class_rows")).first()[0]
    labelled = join_checked(usable, weights.select(target, F.col("weight").alias(WEIGHT)), target)
    return labelled.withColumn(LABEL, F.col(target).cast("double")), int(n)


def train_logistic(
    train: DataFrame,
    target: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    c: float = 1.0,
    max_iter: int = 1000,
) -> PipelineModel:
    """L2 logistic regression with inverse strength ``c``, features not rescaled.

    MLlib divides the loss by the sum of the weights, which for balanced weights
    is the number of rows; so a penalty of 1 / (c * n) is the same objective as
    ``c`` times the summed loss plus half the squared norm.
    """
    rows, n = weighted(train, target, numeric)
    classifier = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=max_iter,
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
    )
    return Pipeline(stages=[*feature_stages(categorical, numeric), classifier]).fit(rows)


def train_forest(
    train: DataFrame,
    target: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    trees: int = 300,
    depth: int = 8,
    bins: int = 128,
    seed: int = 42,
    bootstrap: bool = True,
) -> PipelineModel:
    """Random forest; ``bins`` is the number of split candidates per number.

    Without ``bootstrap`` every tree is fitted to all rows as they are.
    """
    rows, _ = weighted(train, target, numeric)
    classifier = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        bootstrap=bootstrap,
    )
    return Pipeline(stages=[*feature_stages(categorical, numeric), classifier]).fit(rows)


def feature_importance(model: PipelineModel, numeric: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance) of a forest, one row per slot of the feature vector."""
    importance = model.stages[-1].featureImportances.toArray().tolist()
    pairs = list(zip(feature_names(model, numeric), importance))
    return df.sparkSession.createDataFrame(pairs, "feature string, importance double")

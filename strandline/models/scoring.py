"""Batch scores, the high-risk table and the evaluation report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.models.features import complete, numeric_inputs
from strandline.operators.aggregates import top_k
from strandline.operators.evaluate import accuracy, confusion, roc_auc
from strandline.sources.zones import write_parquet


def score(model: PipelineModel, df: DataFrame, prefix: str = "") -> DataFrame:
    """The input columns with ``<prefix>prediction`` (0/1) and ``<prefix>score`` = P(class 1).

    A row that lacks one of the model's numbers keeps its place with nulls in both.
    """
    out = model.transform(df)
    usable = complete(numeric_inputs(model))
    return out.select(
        *[F.col(c) for c in df.columns],
        F.when(usable, F.col("prediction").cast("int")).alias(f"{prefix}prediction"),
        F.when(usable, vector_to_array("probability")[1]).alias(f"{prefix}score"),
    )


def score_all(models: Mapping[str, PipelineModel], df: DataFrame, path: str) -> DataFrame:
    """Score with every model in one pass, store the result and return the stored rows.

    Metrics read the stored predictions, so no model runs twice.
    """
    out = df
    for name, model in models.items():
        out = score(model, out, f"{name}_")
    write_parquet(out, path)
    return df.sparkSession.read.parquet(path)


def high_risk(scored: DataFrame, path: str, threshold: float = 0.5) -> DataFrame:
    """Store the rows whose score reaches the threshold, and return them."""
    write_parquet(scored.where(F.col("score") >= threshold), path)
    return scored.sparkSession.read.parquet(path)


def report(
    scored: DataFrame,
    everything: DataFrame,
    target: str,
    logistic: str,
    forest: str,
    importance: DataFrame,
    features: int = 6,
) -> DataFrame:
    """One row: both models' scores, the forest's matrix and top features, sizes.

    ``scored`` are the stored test rows of ``score_all``; ``logistic`` and
    ``forest`` are the names the models have there, ``importance`` is that of the
    forest's features. ``scored_size`` counts the test rows that had all their
    numbers, on which accuracy, area and matrix stand. The positive rate is that of
    ``everything``, not of the test rows.
    """
    parts = []
    for name, alias in ((logistic, "logistic_regression"), (forest, "random_forest")):
        hits = accuracy(scored, target, f"{name}_prediction")
        area = roc_auc(scored, target, f"{name}_score")
        parts.append(
            F.struct(
                F.round(hits.scalar(), 3).alias("accuracy"),
                F.round(area.scalar(), 3).alias("roc_auc"),
            ).alias(alias)
        )
    matrix = confusion(scored, target, f"{forest}_prediction").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("label", "predicted_0", "predicted_1"))),
            lambda r: F.array(r["predicted_0"], r["predicted_1"]),
        )
    )
    best = top_k(importance, "importance", features, ["feature"])
    ranked = best.agg(
        F.transform(
            F.reverse(F.array_sort(F.collect_list(F.struct("importance", "feature")))),
            lambda r: F.struct(
                r["feature"].alias("feature"), F.round(r["importance"], 3).alias("importance")
            ),
        )
    )
    labelled = scored.where(F.col(target).isNotNull())
    tested = labelled.agg(F.count(F.lit(1)))
    usable = labelled.agg(F.count(f"{forest}_score"))
    positive = everything.agg(F.round(F.avg(target), 3))
    return scored.sparkSession.range(1).select(
        *parts,
        matrix.scalar().alias("confusion_matrix_rf"),
        tested.scalar().alias("test_size"),
        usable.scalar().alias("scored_size"),
        positive.scalar().alias("positive_rate"),
        ranked.scalar().alias("top_features"),
    )

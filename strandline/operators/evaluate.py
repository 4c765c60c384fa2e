"""Scores of a binary classifier, as aggregates over stored predictions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import keep


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Two rows (label 0 and 1) with the counts of each prediction, zeros included."""

    def cell(actual: int, predicted: int):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    cells = df.agg(*[cell(a, p).alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)])
    matrix_rows = [
        F.struct(
            F.lit(a).alias("label"),
            F.col(f"c{a}0").alias("predicted_0"),
            F.col(f"c{a}1").alias("predicted_1"),
        )
        for a in (0, 1)
    ]
    return cells.select(F.inline(F.array(*matrix_rows)))


def running_counts(df: DataFrame, label: str, score: str, pieces: int | None = None) -> DataFrame:
    """Per distinct score: its positives and negatives, and those at or above it.

    Rows without label or score do not take part, and neither do NaN scores, which
    have no place in an order; infinite scores do. Equal scores are merged first, so
    a score shared by most rows is one row. The distinct scores are dealt out by
    range, into ``pieces`` (default: the session's shuffle partitions), and stored
    with the number of their range. Counts run inside each range and start from the
    total of the ranges above. The plan is the same for any number of scores.
    """
    value = F.col(score).cast("double")
    known = df.where(F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value))
    merged = known.groupBy(value.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )
    dealt = (
        merged.repartitionByRange(pieces, "score") if pieces else merged.repartitionByRange("score")
    )
    counts = keep(dealt.withColumn("piece", F.spark_partition_id()), "scores")
    sums = counts.groupBy("piece").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    # one row per range, so these windows are as small as the number of partitions
    whole = Window.partitionBy(F.lit(0))
    above = whole.orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "piece",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("p").over(whole).alias("positives"),
        F.sum("n").over(whole).alias("negatives"),
    )
    down = Window.partitionBy("piece").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.join(F.broadcast(starts), "piece").select(
        "score",
        "pos",
        "neg",
        (F.col("p_above") + F.sum("pos").over(down)).alias("tp"),
        (F.col("n_above") + F.sum("neg").over(down)).alias("fp"),
        "positives",
        "negatives",
    )


def roc_auc(df: DataFrame, label: str, score: str, pieces: int | None = None) -> DataFrame:
    """Area under the ROC curve; a tie between the classes counts one half.

    Null where one class is missing.
    """
    points = running_counts(df, label, score, pieces)
    # twice the won pairs, as whole numbers: pos * (2 * negatives below + negatives tied)
    below = F.col("negatives") - F.col("fp")
    won = F.col("pos").cast("decimal(18,0)") * (2 * below + F.col("neg")).cast("decimal(19,0)")
    pairs = 2.0 * F.max("positives").cast("double") * F.max("negatives").cast("double")
    return points.agg(F.try_divide(F.sum(won).cast("double"), pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, pieces: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin.

    The origin's threshold is infinity, also where a score is infinite itself.
    """
    points = running_counts(df, label, score, pieces).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("negatives").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("positives").cast("double")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)

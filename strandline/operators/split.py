"""Exact stratified split and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.joins import join_checked
from strandline.session import keep

STEP = 3  # hex digits added per counting pass: at most 4,096 groups per class and task
LEAF_ROWS = 1_000_000  # rows of one class that may be ranked in one task
DIGITS = 32


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """Position of a row in a fixed pseudo-random order; same on every run."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _with_running_count(counts: DataFrame) -> DataFrame:
    """Add ``through``: rows of the class up to and with this piece of the order."""
    order = Window.partitionBy("__class").orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.withColumn("__through", F.sum("__rows").over(order) + F.col("__before"))


def _counted(hashed: DataFrame, digits: int, *carried: str) -> DataFrame:
    piece = F.substring("__hash", 1, digits).alias("__piece")
    return hashed.groupBy("__class", *carried, piece).agg(F.count(F.lit(1)).alias("__rows"))


def _edge(counts: DataFrame) -> DataFrame:
    """Per class the piece in which the wanted count is reached, with the count before it."""
    before = F.col("__through") - F.col("__rows")
    reached = (F.col("__through") >= F.col("__target")) & (before < F.col("__target"))
    return keep(
        _with_running_count(counts)
        .where(reached)
        .select(
            "__class",
            "__target",
            "__rows",
            F.col("__piece").alias("__edge"),
            before.alias("__before"),
        )
    )


def _cutoffs(hashed: DataFrame, fraction: float, leaf_rows: int) -> DataFrame:
    """The largest hash of the test part per class.

    Ranking a whole class would put it in one task. Instead rows are counted per
    class and hash prefix; only the prefix in which the wanted count is reached
    is looked at more closely, until it is small enough to rank.
    """
    digits = STEP
    size = F.sum("__rows").over(Window.partitionBy("__class"))
    counts = _counted(hashed, digits).withColumns(
        {"__before": F.lit(0), "__target": F.floor(size * F.lit(fraction) + 0.5)}
    )
    while True:
        edge = _edge(counts)
        classes, largest = edge.agg(F.count(F.lit(1)), F.max("__rows")).first()
        inside = join_checked(
            hashed.withColumn("__edge", F.substring("__hash", 1, digits)),
            edge.drop("__rows"),
            ["__class", "__edge"],
        )
        if classes == 0 or largest <= leaf_rows or digits >= DIGITS:
            break
        digits += STEP
        counts = _counted(inside, digits, "__before", "__target")

    ranked = _with_running_count(_counted(inside, DIGITS, "__before", "__target", "__edge"))
    fits = F.when(F.col("__through") <= F.col("__target"), F.col("__piece"))
    # where no row of the edge prefix fits, the test part ends just before the prefix
    cut = F.coalesce(F.max(fits), F.max("__edge"))
    return keep(ranked.groupBy("__class").agg(cut.alias("__cut")))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str] | None = None,
    fraction: float = 0.25,
    seed: int = 42,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Mark ``round(fraction * n)`` rows of every class as ``is_test``.

    ``keys`` identify a row (default: all columns). Rows that agree on all keys
    stay on one side, so the counts are exact where the keys are unique. Rows
    without a label belong to neither side: their ``is_test`` is null.
    """
    position = row_hash(keys or df.columns, seed)
    hashed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("__class"), position.alias("__hash")
    )
    # the input is run twice: here, and when its rows are marked
    cuts = _cutoffs(keep(hashed, "hashes"), fraction, leaf_rows).withColumnRenamed("__class", label)
    marked = join_checked(df, cuts, label, "left")
    inside = F.coalesce(position <= F.col("__cut"), F.lit(False))
    return marked.select(
        *[F.col(c) for c in df.columns],
        F.when(F.col(label).isNotNull(), inside).alias("is_test"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)``, one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("class_rows")
    )
    over_classes = Window.partitionBy(F.lit(0))  # one row per class
    n, k = F.sum("class_rows").over(over_classes), F.count(F.lit(1)).over(over_classes)
    return counts.withColumn("weight", n / (k * F.col("class_rows")))

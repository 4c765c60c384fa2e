"""Gold that follows streamed Silver.

A table of partial states is kept per Silver table, a partition per day. A refresh compares
the files each day of Silver has now with those the day's states were made from, reads the
days that differ, and replaces their states. Gold tables are merged from the states, so
their cost follows the days a batch touched, late rows included, and the number of states.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import as_column
from strandline.operators.states import Metric, from_states, merged_states, partial_states
from strandline.schemas import Table
from strandline.session import path_exists
from strandline.streaming.readings import DAY, QUERY, day_rows, silver_files

MADE_FROM = "state_of"  # fingerprint of the files a day's states were made from


def refresh_states(
    spark: SparkSession,
    table: Table,
    silver: str,
    states: str,
    keys: Mapping[str, Column | str],
    metrics: Mapping[str, Metric],
) -> int:
    """Bring the states in folder ``states`` up to the streamed Silver table; gives the number of days made anew.

    ``keys`` are the finest dimensions that any Gold table needs, beside the day. A refresh
    that fails half way leaves days that still carry their old fingerprint, so the next one
    makes them. A batch that arrives meanwhile is taken by the next refresh, at the latest.
    """
    files = silver_files(spark, silver).groupBy(DAY)
    found = files.agg(F.bit_xor(F.xxhash64("path")).alias(MADE_FROM), F.countDistinct(QUERY).alias("streams"))
    if path_exists(spark, states):
        found = found.join(spark.read.parquet(states).select(DAY, MADE_FROM).distinct(), [DAY, MADE_FROM], "left_anti")
    # a row per day, as many as the table has partitions
    days = found.collect()
    if not days:
        return 0
    made_from = spark.createDataFrame([(r[DAY], r[MADE_FROM]) for r in days], f"{DAY} string, {MADE_FROM} long")
    shared = [r[DAY] for r in days if r["streams"] > 1]
    rows = day_rows(spark, table, silver, [r[DAY] for r in days], shared).join(F.broadcast(made_from), DAY)
    by = [DAY, MADE_FROM, *[as_column(c).alias(name) for name, c in keys.items()]]
    (
        partial_states(rows, by, metrics)
        .hint("rebalance", F.col(DAY))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(states)
    )
    return len(days)


def read_states(spark: SparkSession, states: str) -> DataFrame:
    return spark.read.parquet(states)


def state_day() -> Column:
    """The day of a state as a date; null for rows without an event time."""
    return F.when(~F.col(DAY).startswith("none-"), F.col(DAY)).cast("date")


def kpi_of_parents(
    states: DataFrame,
    parents: DataFrame,
    key: str,
    dim: str,
    metrics: Mapping[str, Metric],
    parent_count: str = "parents",
) -> DataFrame:
    """Metrics of child rows per attribute of their parent, from states per ``key``.

    As ``join_kpi`` on the rows themselves: parents that occur n times count their children
    n times, and the count is that of distinct keys. All states must be sums, as those of
    ``mean``, ``total`` and ``count`` are.
    """
    per_key = merged_states(states.where(F.col(key).isNotNull()), [key], metrics)
    per_parent = parents.where(F.col(key).isNotNull()).groupBy(key, dim).agg(F.count(F.lit(1)).alias("__copies"))
    parts = [f"{name}__{part}" for name, m in metrics.items() for part in m.parts]
    joined = per_parent.join(per_key, key).withColumns({p: F.col(p) * F.col("__copies") for p in parts})
    counted = joined.groupBy(dim).agg(
        F.count(F.lit(1)).alias(parent_count), *[F.sum(p).alias(p) for p in parts]
    )
    return from_states(counted, [dim, parent_count], metrics)

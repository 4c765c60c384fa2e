"""A dictionary of category levels as a table: however many there are, no driver holds them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.joins import BROADCAST_BYTES, join_dealt, planned_bytes
from strandline.session import keep


def _items(df: DataFrame, columns: Sequence[str], *others: str) -> DataFrame:
    """A row (others.., feature, level) for every value of these columns that is not null."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(*others, F.inline(F.filter(pairs, lambda p: p["level"].isNotNull())))


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored rows (feature, level, slot): the levels of each column in alphabetical order, slots from 0.

    The columns follow one another in the given order, as in the encoded vector. Distinct
    levels merge on the map side and are dealt out by range; a level's slot is its place in
    its range plus the levels before that range, of which there is a count per range and
    column. Columns without a level have no rows; nulls are no level.
    """
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")).alias("place")
    levels = _items(df, columns).distinct().select("*", order)
    ranged = levels.repartitionByRange("place", "level").sortWithinPartitions("place", "level")
    numbered = keep(
        ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "levels"
    )
    # a row per range: its levels, and the number its first one has
    ranges = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return numbered.join(F.broadcast(starts), "part").select(
        "feature", "level", (F.col("before") + F.col("at") - F.col("first")).alias("slot")
    )


def encoded_rows(df: DataFrame, levels: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Rows (key, feature, level, slot): the slots that are 1 in the encoding of each row.

    A null, or a level that ``levels`` does not have, has no row. The dictionary is
    broadcast if it is within the checked size; beyond, rows meet it by a join that deals
    frequent levels over many tasks. Hand in a stored ``levels``.
    """
    items = _items(df, columns, key)
    if planned_bytes(levels) <= BROADCAST_BYTES:
        found = items.join(F.broadcast(levels), ["feature", "level"])
    else:
        item = F.struct("feature", "level")
        known = levels.select(item.alias("item"), "slot")
        found = join_dealt(items.withColumn("item", item), known, "item")
    return found.select(key, "feature", "level", "slot")

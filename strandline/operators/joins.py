"""Joins and row generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.columns import as_column
from strandline.session import keep

BROADCAST_BYTES = 64 << 20
CELLS = 8  # of a hot key for each even share of the rows


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; for a stored frame it follows from its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_checked(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with a side that is expected to be small, without trusting that.

    Only if the optimizer's estimate for it is within ``max_bytes`` it is broadcast;
    beyond, the join is left to Spark, which shuffles both sides and splits skewed
    keys at run time. No job runs to find out. Hand in a frame that is read or
    stored: behind a filter or a join the estimate may be far too high or too low.
    """
    return big.join(F.broadcast(small) if planned_bytes(small) <= max_bytes else small, on, how)


def join_dealt(big: DataFrame, small: DataFrame, on: str, how: str = "inner", parts: int | None = None) -> DataFrame:
    """Join on a key of which a few values may hold most rows of ``big``.

    Keys are counted first. One with more rows than an even share of ``parts`` tasks (the
    shuffle partitions) is hot: its rows in ``big`` are dealt out over cells of an eighth of
    such a share, which spread well, and its rows in ``small`` are copied to each of these
    cells. There are at most ``parts`` hot keys, which are broadcast, and nine times as many
    cells. All other keys are joined as they are, in the same join, so nothing depends on
    what the optimizer may split at run time. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    A null key matches nothing; in a left join such rows are dealt out too. It reads the key
    column of ``big`` once more.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would see a copied row of the small side more than once")
    spark = big.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if how in ("inner", "left_semi"):
        big = big.where(F.col(on).isNotNull())
    small = small.where(F.col(on).isNotNull())
    counts = big.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("__rows"))
    whole = counts.agg(F.sum("__rows")).scalar()
    cells = F.ceil(F.col("__rows") * parts * CELLS / whole).cast("int").alias("__cells")
    hot = keep(counts.where(F.col("__rows") * parts > whole).select(on, cells), "hot-keys")
    own = F.when(F.col(on).isNull(), parts * CELLS).otherwise(F.coalesce("__cells", F.lit(1)))
    # numbers of neighbouring rows differ by one, so each task deals evenly
    cell = F.pmod(F.monotonically_increasing_id(), own.cast("long")).cast("int")
    dealt = big.join(F.broadcast(hot), on, "left").withColumn("__cell", cell).drop("__cells")
    every = F.sequence(F.lit(0), F.coalesce("__cells", F.lit(1)) - 1)
    copied = small.join(F.broadcast(hot), on, "left").withColumn("__cell", F.explode(every)).drop("__cells")
    return dealt.join(copied, [on, "__cell"], how).drop("__cell")


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Add the attributes of a dimension. Rows without a match get nulls."""
    return join_checked(df, dim, on, "left")


def join_kpi(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    dim: str,
    measures: Mapping[str, tuple[str, int, float]],
    parent_count: str = "parents",
    order_by: str | None = None,
) -> DataFrame:
    """Averages over child rows per attribute of their parent.

    ``measures`` maps an output name to (child column, digits, scale). The result
    is that of joining children to parents on ``key``, grouping by ``dim``,
    counting distinct keys and averaging over the joined rows.

    Both sides are reduced before they meet: children to a sum and a count per
    key, parents to a row count per key and attribute. So the join moves one row
    per key instead of every child row, a key with a third of all rows is merged
    on the map side, and the distinct count is a plain count, as each key occurs
    once per attribute.
    """
    per_key = children.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.sum(c).alias(f"{name}__sum") for name, (c, _, _) in measures.items()],
        *[F.count(c).alias(f"{name}__n") for name, (c, _, _) in measures.items()],
    )
    per_parent = parents.where(F.col(key).isNotNull()).groupBy(key, dim).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    totals = []
    for name, (_, digits, scale) in measures.items():
        total = F.sum(F.col(f"{name}__sum") * F.col("__copies"))
        count = F.sum(F.col(f"{name}__n") * F.col("__copies"))
        mean = F.try_divide(total.cast("double"), count.cast("double"))
        totals.append(F.round(mean * scale if scale != 1 else mean, digits).alias(name))
    out = (
        per_parent.join(per_key, key, "inner")
        .groupBy(dim)
        .agg(F.count(F.lit(1)).alias(parent_count), *totals)
    )
    if order_by is None:
        return out
    return out.orderBy(F.desc_nulls_last(order_by), F.asc_nulls_last(dim))


def time_spine(
    dims: DataFrame, start: Column, end: Column, step: str = "1 hour", name: str = "snapshot_ts"
) -> DataFrame:
    """Every step from ``start`` to ``end`` (inclusive) for every row of ``dims``.

    The steps are generated from each dimension row, so there is no join.
    ``start`` and ``end`` may be scalar subqueries over the data.
    """
    steps = F.sequence(start, end, F.expr(f"interval {step}"))
    return dims.withColumn(name, F.explode(steps))


def expand_children(
    parents: DataFrame, n: Column | str, number: str = "child_no", chunk: int = 100_000
) -> DataFrame:
    """Each parent row ``n`` times, numbered from 1, its columns carried down.

    ``n`` below 1, or null, counts as 1. Children are generated in chunks of
    ``chunk`` numbers, and the chunks are spread evenly over all tasks first; a
    parent with a few children is one chunk. The parents are read once, so ``n``
    may come from an input that is not the same when read again.
    """
    one = F.lit(1).cast("long")
    counted = parents.withColumn("__n", F.greatest(one, as_column(n).cast("long")))
    starts = F.sequence(one, F.col("__n"), F.lit(chunk).cast("long"))
    last = F.least(F.col("__n"), F.col("__from") + F.lit(chunk - 1))
    return (
        counted.withColumn("__from", F.explode(starts))
        .hint("rebalance")
        .withColumn(number, F.explode(F.sequence(F.col("__from"), last)))
        .drop("__from", "__n")
    )

"""Metrics as partial states that merge.

A metric is computed in two steps: partial states per key, which may be stored, and their
merge to any coarser key. Merging the states of all parts of a table gives what the metric
gives over the whole table, so a part that changed is the only one to be read again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.columns import as_column, percent

SKETCH_BITS = 14  # a distinct count from sketches is off by about 0.8 %


@dataclass(frozen=True)
class Metric:
    """``parts`` maps the name of a partial state to (aggregate over rows, aggregate over states).

    ``finish`` makes the value from the merged states, in the same order.
    """

    parts: Mapping[str, tuple[Column, Callable[[str], Column]]]
    finish: Callable[..., Column]


def total(c: Column | str) -> Metric:
    return Metric({"sum": (F.sum(as_column(c)), F.sum)}, lambda s: s)


def highest(c: Column | str) -> Metric:
    return Metric({"max": (F.max(as_column(c)), F.max)}, lambda m: m)


def lowest(c: Column | str) -> Metric:
    return Metric({"min": (F.min(as_column(c)), F.min)}, lambda m: m)


def count() -> Metric:
    return Metric({"rows": (F.count(F.lit(1)), F.sum)}, lambda n: n)


def mean(c: Column | str, digits: int | None = None, scale: float | None = None) -> Metric:
    """Mean of the non-null values, null if there is none; scaled before it is rounded."""

    def finish(s: Column, n: Column) -> Column:
        value = F.try_divide(s.cast("double"), n.cast("double"))
        if scale is not None:
            value = value * scale
        return value if digits is None else F.round(value, digits)

    return Metric({"sum": (F.sum(as_column(c)), F.sum), "n": (F.count(as_column(c)), F.sum)}, finish)


def share(flag: Column | str, digits: int = 1) -> Metric:
    """Percentage of ones of a 0/1 flag among its known values."""
    base = mean(flag)
    return Metric(base.parts, lambda s, n: percent(base.finish(s, n), digits))


def distinct(c: Column | str) -> Metric:
    """Distinct count by sketches of fixed size, which merge; nulls do not count.

    It is exact for small numbers only. Where it must be exact, keep states per value and
    count these.
    """
    text = as_column(c).cast("string")
    parts = {"sketch": (F.hll_sketch_agg(text, F.lit(SKETCH_BITS)), F.hll_union_agg)}
    return Metric(parts, lambda s: F.coalesce(F.hll_sketch_estimate(s), F.lit(0).cast("long")))


def partial_states(df: DataFrame, keys: Sequence[Column | str], metrics: Mapping[str, Metric]) -> DataFrame:
    """One row per combination of ``keys`` with the states of all metrics, as <metric>__<part>."""
    aggregates = [
        rows.alias(f"{name}__{part}") for name, m in metrics.items() for part, (rows, _) in m.parts.items()
    ]
    return df.groupBy(*keys).agg(*aggregates)


def merged_states(states: DataFrame, keys: Sequence[Column | str], metrics: Mapping[str, Metric]) -> DataFrame:
    """States merged to coarser keys; they may be merged again."""
    aggregates = [
        merge(f"{name}__{part}").alias(f"{name}__{part}")
        for name, m in metrics.items()
        for part, (_, merge) in m.parts.items()
    ]
    return states.groupBy(*keys).agg(*aggregates)


def from_states(states: DataFrame, keys: Sequence[Column | str], metrics: Mapping[str, Metric]) -> DataFrame:
    """The metrics per combination of ``keys``, from states of the same or finer keys."""
    merged = merged_states(states, keys, metrics)
    values = [m.finish(*[F.col(f"{name}__{part}") for part in m.parts]).alias(name) for name, m in metrics.items()]
    names = [c for c in merged.columns if "__" not in c or c.split("__")[0] not in metrics]
    return merged.select(*[F.col(f"`{c}`") for c in names], *values)

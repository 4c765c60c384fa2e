"""KPI tables.

Each is one grouped aggregate: every function used merges on the map side, so a
group key that holds most of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.columns import as_column, band, percent, to_day


# --- metrics, for the ``metrics`` mappings below ---


def avg_of(c: Column | str, digits: int | None = None, scale: float | None = None) -> Column:
    """Mean of the non-null values; scaled before it is rounded."""
    value = F.avg(as_column(c))
    if scale is not None:
        value = value * scale
    return value if digits is None else F.round(value, digits)


def max_of(c: Column | str) -> Column:
    return F.max(as_column(c))


def sum_of(c: Column | str) -> Column:
    return F.sum(as_column(c))


def rows() -> Column:
    return F.count(F.lit(1))


def distinct_of(c: Column | str, approximate: bool = False) -> Column:
    """Exact distinct count, or a sketch of fixed size where that is enough."""
    return F.approx_count_distinct(as_column(c)) if approximate else F.countDistinct(as_column(c))


def rate_of(c: Column | str) -> Column:
    """Share of ones of a 0/1 flag, or of rows where a predicate holds; nulls are skipped."""
    return F.avg(as_column(c).cast("int"))


# --- tables ---


def kpi_by_dim(
    df: DataFrame,
    dims: Sequence[str | Column],
    metrics: Mapping[str, Column],
    order_by: str | None = None,
) -> DataFrame:
    """One row per combination of ``dims``; optionally by one metric, largest first.

    Ties are settled by the dimensions so that the order is always the same.
    """
    grouped = df.groupBy(*dims).agg(*[m.alias(name) for name, m in metrics.items()])
    if order_by is None:
        return grouped
    names = [c for c in grouped.columns if c not in metrics]
    return grouped.orderBy(F.desc_nulls_last(order_by), *[F.asc_nulls_last(c) for c in names])


def band_rate(
    df: DataFrame,
    dims: Sequence[str],
    value: str,
    bounds: Sequence[tuple[float, str]],
    rest: str,
    positive: str,
    names: tuple[str, str, str, str] = ("band", "total", "positives", "rate_pct"),
    ordered: bool = False,
) -> DataFrame:
    """Rows, positives and rate of a 0/1 flag per dimension and value band.

    With no ``dims`` it gives the rate per band alone. The rate is over rows
    whose flag is known, ``total`` counts all rows.
    """
    band_name, total, positives, rate = names
    metrics = {
        total: rows(),
        positives: sum_of(positive),
        rate: percent(F.avg(positive), 1),
    }
    keys = [*dims, band(value, bounds, rest).alias(band_name)]
    return kpi_by_dim(df, keys, metrics, order_by=rate if ordered else None)


def daily_trend(
    df: DataFrame, ts: Column | str, metrics: Mapping[str, Column], day: str = "day"
) -> DataFrame:
    """One row per calendar day, oldest first, days unknown last.

    The sort works on the aggregated days only.
    """
    grouped = df.groupBy(to_day(ts).alias(day)).agg(*[m.alias(n) for n, m in metrics.items()])
    return grouped.orderBy(F.asc_nulls_last(day))


def profile(tables: Mapping[str, DataFrame], rates: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Row count and flag rates per table as (table_name, metric, value).

    Every table is read once, with only the columns its rates need.
    """
    parts = []
    for name, df in tables.items():
        wanted = {"rows": rows().cast("double")}
        wanted |= {m: F.round(rate_of(c), 3) for m, c in rates.get(name, {}).items()}
        one_row = df.agg(*[c.alias(m) for m, c in wanted.items()])
        parts.append(
            one_row.unpivot([], list(wanted), "metric", "value").select(
                F.lit(name).alias("table_name"), "metric", "value"
            )
        )
    out, *others = parts
    for part in others:
        out = out.unionByName(part)
    return out


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest value; each task keeps at most ``k``."""
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in tie_break]]
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int = 10, key: str | None = None) -> DataFrame:
    """Some ``n`` rows, read from as few files as possible; with a ``key`` the first by it."""
    return df.limit(n) if key is None else df.orderBy(F.asc_nulls_last(key)).limit(n)

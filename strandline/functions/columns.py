"""Column expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.schemas import TS_PATTERN, Below

# Fixed values: %-style date fields and their Java pattern letters.
PERCENT_FIELDS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%c": "M",
    "%d": "dd",
    "%e": "d",
    "%j": "DDD",
    "%H": "HH",
    "%k": "H",
    "%h": "hh",
    "%I": "hh",
    "%l": "h",
    "%i": "mm",
    "%S": "ss",
    "%s": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%M": "MMMM",
    "%a": "EEE",
    "%W": "EEEE",
    "%T": "HH:mm:ss",
    "%r": "hh:mm:ss a",
    "%%": "'%'",
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- casts and parsing: bad text becomes null, it never fails the job ---


def to_double(c: Column | str) -> Column:
    return as_column(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Text or number to int, cutting fractions: ``'2.9'`` is 2, ``'abc'`` is null."""
    return to_double(c).try_cast("int")


def to_moment(c: Column | str, pattern: str = TS_PATTERN) -> Column:
    return F.try_to_timestamp(as_column(c), F.lit(pattern))


def java_pattern(percent_pattern: str) -> str:
    """The Java pattern of a %-style one. Letters outside of fields stand for themselves."""
    out = []
    for field, letters, other in re.findall(r"(%.?)|([A-Za-z']+)|([^%A-Za-z']+)", percent_pattern, re.DOTALL):
        if field and field not in PERCENT_FIELDS:
            raise ValueError(f"{field} is no date field that can be parsed")
        out.append(PERCENT_FIELDS.get(field) or other or "'" + letters.replace("'", "''") + "'")
    return "".join(out)


def to_moment_percent(c: Column | str, percent_pattern: str) -> Column:
    """Parse by a pattern such as ``'%Y-%m-%d %H:%i:%s'``."""
    return to_moment(c, java_pattern(percent_pattern))


def to_day(ts: Column | str) -> Column:
    return F.to_date(as_column(ts))


# --- numbers ---


def ratio(a: Column | str, b: Column | str, digits: int | None = None) -> Column:
    """``a / b``, null where ``b`` is zero."""
    value = F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))
    return value if digits is None else F.round(value, digits)


def percent(rate: Column | str, digits: int = 1) -> Column:
    """Scale first, then round half up."""
    return F.round(as_column(rate) * 100, digits)


def clamp(c: Column | str, low=None, high=None) -> Column:
    """Limit to a range open on either side; null stays null."""
    value = as_column(c)
    bounded = value
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    # least/greatest skip nulls and would turn a null into the bound
    return F.when(value.isNotNull(), bounded)


def trunc_int(c: Column | str) -> Column:
    """Cut toward zero."""
    return as_column(c).try_cast("int")


# --- labels and flags ---


def band(c: Column | str, bounds: Sequence[tuple[float | Below, str]], rest: str) -> Column:
    """Label of the first upper bound that holds the value.

    A bound belongs to its band, unless it is marked ``Below``. Values above the last
    bound, and nulls, take ``rest``.
    """
    value = as_column(c)

    def holds(bound: float | Below) -> Column:
        return value < bound.bound if isinstance(bound, Below) else value <= bound

    (first, label), *others = bounds
    labelled = F.when(holds(first), label)
    for bound, name in others:
        labelled = labelled.when(holds(bound), name)
    return labelled.otherwise(rest)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def either(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, yes).otherwise(no)


def rule_score(
    category: Column | str,
    base: Mapping[str, float],
    bonuses: Iterable[tuple[Column, float]],
    cap: float,
) -> Column:
    """Base per category plus a bonus per condition that holds, up to ``cap``.

    A category without a base gives null.
    """
    pairs = [F.lit(x) for item in base.items() for x in item]
    score = F.try_element_at(F.create_map(*pairs), as_column(category))
    for condition, bonus in bonuses:
        score = score + F.when(condition, F.lit(bonus)).otherwise(F.lit(0.0))
    return clamp(score, high=cap)


def padded_id(number: Column | str, prefix: str, width: int) -> Column:
    """Zero-padded id; numbers wider than ``width`` keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", as_column(number))


# --- time ---


def add_time(ts: Column | str, days=0, hours=0, minutes=0) -> Column:
    """Shift a timestamp by whole days, hours and minutes (numbers or columns)."""
    parts = [x if isinstance(x, Column) else F.lit(x) for x in (days, hours, minutes)]
    return as_column(ts) + F.make_dt_interval(*[p.cast("int") for p in parts])


def ts_text(ts: Column | str, pattern: str = TS_PATTERN) -> Column:
    return F.date_format(as_column(ts), pattern)


def diurnal_factor(ts: Column | str, amplitude: float = 0.4, zero_hour: int = 6) -> Column:
    """Daily wave around 1.0: it is 1 at ``zero_hour`` and peaks six hours later."""
    turn = (F.hour(as_column(ts)) - zero_hour) / F.lit(24.0)
    return 1.0 + amplitude * F.sin(turn * 2 * F.pi())

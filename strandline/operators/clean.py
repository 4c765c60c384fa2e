"""Bronze text to Silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.columns import to_day, to_double, to_int, to_moment
from strandline.schemas import MOMENT, REAL, TEXT, WHOLE, Table

CASTS = {TEXT: F.col, WHOLE: to_int, REAL: to_double, MOMENT: to_moment}


def typed(df: DataFrame, table: Table) -> DataFrame:
    """One projection that casts every declared column and adds the derived days.

    Rows lacking a required column are left out before anything is cast.
    """
    rows = df.dropna(subset=list(table.required)) if table.required else df
    cast = [CASTS[kind](c).alias(c) for c, kind in table.columns.items()]
    out = rows.select(*cast)
    return out.withColumns({day: to_day(ts) for day, ts in table.day_of.items()})


def clean(df: DataFrame, table: Table) -> DataFrame:
    """Typed rows without whole-row copies.

    Copies are removed after the casts, so ``72`` and ``72.0`` count as one. The
    map side already merges copies, hence a row repeated any number of times
    reaches the shuffle once per task.
    """
    return typed(df, table).dropDuplicates()

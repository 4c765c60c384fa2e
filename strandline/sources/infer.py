"""Types of CSV columns, found in one pass over a table.

Whether a type holds all values of a column is a conjunction over its values, so it merges
on the map side, for all types and columns in one aggregate with one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a value may be, the narrower type of a family first. A column is of the first type that
# holds all its values; with values of several families, and without any, it is text.
NUMBER = r"^[+-]?\d+$"
REAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(NaN|Infinity)$"
DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
MOMENT = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d"


def _holds(text: Column) -> dict[str, Column]:
    """Whether a value, which is not null, is of a type. A long is a real too, and a day a moment."""
    day = text.rlike(DAY) & text.try_cast("date").isNotNull()
    return {
        "int": text.rlike(NUMBER) & text.try_cast("int").isNotNull(),
        "bigint": text.rlike(NUMBER) & text.try_cast("bigint").isNotNull(),
        "double": text.rlike(REAL),
        "date": day,
        "timestamp": day | text.rlike(MOMENT) & text.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(text).isin("true", "false"),
    }


def inferred_schema(rows: DataFrame) -> T.StructType:
    """Types for the text columns of ``rows``, read once. Nulls, and texts that are empty, fit any type."""
    aggregates = []
    for i, c in enumerate(rows.columns):
        text = F.col(f"`{c}`")
        known = text.isNotNull() & (text != "")
        aggregates += [F.min(F.when(known, holds)).alias(f"{i}_{kind}") for kind, holds in _holds(text).items()]
    found = rows.agg(*aggregates).first() if aggregates else {}
    fields = []
    for i, c in enumerate(rows.columns):
        kind = next((k for k in _holds(F.lit("")) if found[f"{i}_{k}"]), "string")
        fields.append(T.StructField(c, T.StringType() if kind == "string" else T.StructType.fromDDL(f"x {kind}")["x"].dataType))
    return T.StructType(fields)


def infer_csv(spark: SparkSession, path: str, options: Mapping[str, str]) -> T.StructType:
    """Names from the header line, types from all values; the files are read once."""
    reader = spark.read.options(**options)
    names = reader.option("inferSchema", "false").csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return inferred_schema(reader.schema(text).csv(path))

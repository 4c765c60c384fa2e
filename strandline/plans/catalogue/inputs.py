"""Input frames of the queries, and the same inputs as DuckDB SQL.

The given tables are clean. The ``text_*`` inputs turn them into Bronze rows as a
source system may send them: every column is text, every row comes twice with its
numbers written differently, and keys, numbers and timestamps are missing or
unreadable wherever a condition on the row holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import ts_text
from strandline.schemas import MOMENT, REAL, TEXT, WHOLE, Table


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_copies(df: DataFrame) -> DataFrame:
    return df.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))


def whole_text(c: str):
    """An int as ``12`` in the first copy and ``12.7`` in the second."""
    return F.concat(F.col(c).cast("string"), F.when(F.col("copy") == 1, ".7").otherwise(""))


def real_text(c: str):
    """A double as ``1.5`` in the first copy and with blanks around in the second."""
    pad = F.when(F.col("copy") == 1, " ").otherwise("")
    return F.concat(pad, F.col(c).cast("string"), pad)


# Stand-ins for readings (fact), admissions (parent) and snapshots (operations).

READINGS = Table(
    name="readings",
    columns={
        "l_orderkey": TEXT,
        "l_linenumber": WHOLE,
        "l_linestatus": TEXT,
        "l_shipdate": MOMENT,
        "l_quantity": REAL,
        "l_discount": REAL,
        "l_partkey": WHOLE,
    },
    required=("l_orderkey",),
    time="l_shipdate",
)

ADMISSIONS = Table(
    name="admissions",
    columns={
        "o_orderkey": TEXT,
        "o_custkey": WHOLE,
        "o_orderpriority": TEXT,
        "o_orderdate": MOMENT,
        "o_totalprice": WHOLE,
    },
    required=("o_orderkey",),
)

SNAPSHOTS = Table(
    name="snapshots",
    columns={
        "event_id": TEXT,
        "ts": MOMENT,
        "user_id": WHOLE,
        "event_type": TEXT,
        "value": REAL,
    },
    day_of={"day": "ts"},
    partition_by=("event_type",),
    time="ts",
)


def text_readings(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_copies(given(spark, folder, "lineitem"))
    return rows.select(
        F.when(F.col("l_returnflag") != "A", F.col("l_orderkey").cast("string")).alias("l_orderkey"),
        whole_text("l_linenumber").alias("l_linenumber"),
        "l_linestatus",
        F.when(F.col("l_tax") >= 0.08, "n/a").otherwise(ts_text("l_shipdate")).alias("l_shipdate"),
        real_text("l_quantity").alias("l_quantity"),
        F.when(F.col("l_quantity") > 45, "bad").otherwise(real_text("l_discount")).alias("l_discount"),
        whole_text("l_partkey").alias("l_partkey"),
    )


TEXT_READINGS = """
  SELECT CASE WHEN l_returnflag <> 'A' THEN CAST(l_orderkey AS VARCHAR) END AS l_orderkey,
         CAST(l_linenumber AS VARCHAR) || CASE WHEN copy = 1 THEN '.7' ELSE '' END AS l_linenumber,
         l_linestatus,
         CASE WHEN l_tax >= 0.08 THEN 'n/a'
              ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS l_shipdate,
         CAST(l_quantity AS VARCHAR) AS l_quantity,
         CASE WHEN l_quantity > 45 THEN 'bad' ELSE CAST(l_discount AS VARCHAR) END AS l_discount,
         CAST(l_partkey AS VARCHAR) || CASE WHEN copy = 1 THEN '.7' ELSE '' END AS l_partkey
  FROM lineitem CROSS JOIN (VALUES (0), (1)) AS c(copy)
"""


def text_admissions(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_copies(given(spark, folder, "orders"))
    return rows.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("o_orderkey"),
        F.when(F.col("o_totalprice") < 50000, "abc").otherwise(whole_text("o_custkey")).alias("o_custkey"),
        "o_orderpriority",
        F.when(F.col("o_totalprice") > 400000, "soon").otherwise(ts_text("o_orderdate")).alias("o_orderdate"),
        real_text("o_totalprice").alias("o_totalprice"),
    )


TEXT_ADMISSIONS = """
  SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
         CASE WHEN o_totalprice < 50000 THEN 'abc'
              ELSE CAST(o_custkey AS VARCHAR) || CASE WHEN copy = 1 THEN '.7' ELSE '' END
         END AS o_custkey,
         o_orderpriority,
         CASE WHEN o_totalprice > 400000 THEN 'soon'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
         CAST(o_totalprice AS VARCHAR) AS o_totalprice
  FROM orders CROSS JOIN (VALUES (0), (1)) AS c(copy)
"""


def text_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_copies(given(spark, folder, "events"))
    return rows.select(
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("value") > 60, "n/a").otherwise(ts_text("ts")).alias("ts"),
        whole_text("user_id").alias("user_id"),
        "event_type",
        F.when(F.col("value") < 1, "bad").otherwise(real_text("value")).alias("value"),
    )


TEXT_SNAPSHOTS = """
  SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN value > 60 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         CAST(user_id AS VARCHAR) || CASE WHEN copy = 1 THEN '.7' ELSE '' END AS user_id,
         event_type,
         CASE WHEN value < 1 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS value
  FROM events CROSS JOIN (VALUES (0), (1)) AS c(copy)
"""


def sql_int(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"


def sql_double(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def sql_moment(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, the form in which the twins have them."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if kinds[c] == "timestamp" else F.col(c) for c in df.columns]
    )

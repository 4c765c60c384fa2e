"""Projections, filters, casts and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import columns as C
from strandline.operators.aggregates import preview
from strandline.plans.catalogue.inputs import (
    TEXT_ADMISSIONS,
    TEXT_READINGS,
    TEXT_SNAPSHOTS,
    given,
    sql_double,
    sql_int,
    sql_moment,
    text_admissions,
    text_readings,
    text_snapshots,
    without_zone,
)

LINE_KEY = ("l_orderkey", "l_linenumber")


def preview_query(spark: SparkSession, folder: str) -> DataFrame:
    return preview(given(spark, folder, "orders"), 10, "o_orderkey")


def project_cols(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_returnflag")


def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return text_admissions(spark, folder).dropna(subset=["o_orderkey"]).withColumn(
        "o_totalprice", C.to_double("o_totalprice")  # the engines write doubles differently
    )


FILTER_NOT_NULL = f"""
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, {sql_double('o_totalprice')} AS o_totalprice
FROM ({TEXT_ADMISSIONS}) WHERE o_orderkey IS NOT NULL
"""


def cast_int(spark: SparkSession, folder: str) -> DataFrame:
    return text_admissions(spark, folder).select("o_orderkey", C.to_int("o_custkey").alias("custkey"))


def cast_double(spark: SparkSession, folder: str) -> DataFrame:
    rows = text_readings(spark, folder)
    return rows.select(
        "l_orderkey",
        C.to_double("l_quantity").alias("quantity"),
        C.to_double("l_discount").alias("discount"),
    )


CAST_DOUBLE = f"""
SELECT l_orderkey, {sql_double('l_quantity')} AS quantity, {sql_double('l_discount')} AS discount
FROM ({TEXT_READINGS})
"""


def parse_ts(spark: SparkSession, folder: str) -> DataFrame:
    rows = text_snapshots(spark, folder)
    return without_zone(rows.select("event_id", C.to_moment("ts").alias("parsed")))


def parse_ts_percent(spark: SparkSession, folder: str) -> DataFrame:
    """Two patterns; the second has a letter of its own between date and time."""
    rows = text_snapshots(spark, folder)
    other = F.date_format(F.to_timestamp_ntz("ts_known"), "dd/MM/yy'T'HH.mm.ss")
    known = rows.withColumn("ts_known", F.when(F.col("ts") != "n/a", F.col("ts"))).withColumn("other", other)
    return without_zone(
        known.select(
            "event_id",
            C.to_moment_percent("ts", "%Y-%m-%d %H:%i:%s").alias("parsed"),
            C.to_moment_percent("other", "%d/%m/%yT%H.%i.%s").alias("parsed_other"),
        )
    )


PARSE_TS = f"SELECT event_id, {sql_moment('ts')} AS parsed FROM ({TEXT_SNAPSHOTS})"


def ts_to_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "lineitem")
    return rows.select(*LINE_KEY, C.to_day("l_shipdate").alias("ship_day"))


def round_digits(spark: SparkSession, folder: str) -> DataFrame:
    """Rounded decimals: a half is then the same half in every engine."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
    rows = given(spark, folder, "lineitem")
    return rows.select(
        *LINE_KEY,
        *[F.round(amount, n).cast("double").alias(f"rounded_{n}") for n in range(4)],
        # quarters are doubles without an error, so a half is a half here too
        *[F.round(F.col("l_quantity") / 4 + 0.125, n).alias(f"double_{n}") for n in range(3)],
    )


ROUND_DIGITS = f"""
SELECT l_orderkey, l_linenumber,
       {', '.join(f'CAST(ROUND(amount, {n}) AS DOUBLE) AS rounded_{n}' for n in range(4))},
       {', '.join(f'ROUND(l_quantity / 4 + 0.125::DOUBLE, {n}) AS double_{n}' for n in range(3))}
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS amount
      FROM lineitem)
"""


def ratio_pct(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "lineitem")
    return rows.select(
        *LINE_KEY,
        C.ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        C.ratio("l_discount", "l_tax").alias("discount_per_tax"),
        C.percent("l_discount", 1).alias("discount_pct"),
    )


RATIO_PCT = """
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
       l_discount / NULLIF(l_tax, 0) AS discount_per_tax, ROUND(l_discount * 100, 1) AS discount_pct
FROM lineitem
"""


def clamp(spark: SparkSession, folder: str) -> DataFrame:
    known = F.nullif(F.col("l_quantity"), F.lit(25.0))
    rows = given(spark, folder, "lineitem")
    return rows.select(
        *LINE_KEY,
        C.clamp(known, 10.0, 40.0).alias("both"),
        C.clamp(known, low=10.0).alias("at_least"),
        C.clamp(known, high=40.0).alias("at_most"),
    )


CLAMP = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN q < 10 THEN 10.0::DOUBLE WHEN q > 40 THEN 40.0::DOUBLE ELSE q END AS "both",
       CASE WHEN q < 10 THEN 10.0::DOUBLE ELSE q END AS at_least,
       CASE WHEN q > 40 THEN 40.0::DOUBLE ELSE q END AS at_most
FROM (SELECT *, NULLIF(l_quantity, 25) AS q FROM lineitem)
"""


def trunc_int(spark: SparkSession, folder: str) -> DataFrame:
    part = F.col("l_extendedprice") * F.col("l_discount")
    rows = given(spark, folder, "lineitem")
    return rows.select(
        *LINE_KEY, C.trunc_int(part).alias("cut"), C.trunc_int(-part).alias("cut_negative")
    )


TRUNC_INT = """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice * l_discount) AS INTEGER) AS cut,
       CAST(trunc(-(l_extendedprice * l_discount)) AS INTEGER) AS cut_negative
FROM lineitem
"""


def ts_add(spark: SparkSession, folder: str) -> DataFrame:
    later = C.add_time("l_shipdate", days=F.col("l_linenumber"), hours=6, minutes=F.col("l_quantity"))
    return given(spark, folder, "lineitem").select(*LINE_KEY, later.alias("due"))


TS_ADD = """
SELECT l_orderkey, l_linenumber,
       l_shipdate + to_days(l_linenumber) + to_hours(6) + to_minutes(CAST(l_quantity AS BIGINT)) AS due
FROM lineitem
"""


def ts_format(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "events").select("event_id", C.ts_text("ts").alias("ts_text"))


def padded_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "orders")
    return rows.select(
        "o_orderkey",
        C.padded_id("o_orderkey", "P", 5).alias("order_id"),
        C.padded_id("o_custkey", "DEV", 3).alias("device_id"),
    )


PADDED_ID = """
SELECT o_orderkey, printf('P%05d', o_orderkey) AS order_id, printf('DEV%03d', o_custkey) AS device_id
FROM orders
"""


def flag_label(spark: SparkSession, folder: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rows = given(spark, folder, "orders")
    return rows.select(
        "o_orderkey", C.flag(urgent).alias("urgent"), C.either(urgent, "Emergency", "Planned").alias("kind")
    )


FLAG_LABEL = """
SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Emergency' ELSE 'Planned' END AS kind
FROM orders
"""


def rule_score(spark: SparkSession, folder: str) -> DataFrame:
    base = {"1-URGENT": 0.55, "2-HIGH": 0.4, "3-MEDIUM": 0.3, "4-NOT SPECIFIED": 0.2, "5-LOW": 0.1}
    bonuses = [
        (F.col("o_totalprice") > 400000, 0.125),
        (F.col("o_orderstatus").isin("F", "P"), 0.05),
    ]
    score = C.rule_score("o_orderpriority", base, bonuses, cap=0.65)
    return given(spark, folder, "orders").select("o_orderkey", F.round(score, 4).alias("score"))


RULE_SCORE = """
SELECT o_orderkey, ROUND(LEAST(0.65::DOUBLE,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0.55::DOUBLE WHEN '2-HIGH' THEN 0.4::DOUBLE
              WHEN '3-MEDIUM' THEN 0.3::DOUBLE WHEN '4-NOT SPECIFIED' THEN 0.2::DOUBLE
              WHEN '5-LOW' THEN 0.1::DOUBLE END
         + CASE WHEN o_totalprice > 400000 THEN 0.125::DOUBLE ELSE 0.0::DOUBLE END
         + CASE WHEN o_orderstatus IN ('F', 'P') THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END), 4) AS score
FROM orders
"""


def diurnal_factor(spark: SparkSession, folder: str) -> DataFrame:
    factor = F.round(C.diurnal_factor("ts"), 6)
    return given(spark, folder, "events").select("event_id", factor.alias("factor"))


DIURNAL_FACTOR = """
SELECT event_id, ROUND(1.0 + 0.4 * sin((hour(ts) - 6) / 24.0::DOUBLE * 2 * pi()), 6) AS factor
FROM events
"""

ENTRIES = {
    "preview": (preview_query, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10"),
    "project_cols": (
        project_cols,
        "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    ),
    "filter_not_null": (filter_not_null, FILTER_NOT_NULL),
    "cast_int": (
        cast_int,
        f"SELECT o_orderkey, {sql_int('o_custkey')} AS custkey FROM ({TEXT_ADMISSIONS})",
    ),
    "cast_double": (cast_double, CAST_DOUBLE),
    "parse_ts": (parse_ts, PARSE_TS),
    "parse_ts_percent": (
        parse_ts_percent,
        f"SELECT event_id, {sql_moment('ts')} AS parsed, {sql_moment('ts')} AS parsed_other FROM ({TEXT_SNAPSHOTS})",
    ),
    "ts_to_date": (
        ts_to_date,
        "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem",
    ),
    "round_digits": (round_digits, ROUND_DIGITS),
    "ratio_pct": (ratio_pct, RATIO_PCT),
    "clamp": (clamp, CLAMP),
    "trunc_int": (trunc_int, TRUNC_INT),
    "ts_add": (ts_add, TS_ADD),
    "ts_format": (
        ts_format,
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
    ),
    "padded_id": (padded_id, PADDED_ID),
    "flag_label": (flag_label, FLAG_LABEL),
    "rule_score": (rule_score, RULE_SCORE),
    "diurnal_factor": (diurnal_factor, DIURNAL_FACTOR),
}

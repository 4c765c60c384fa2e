"""Silver and Gold tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import flag, ts_text
from strandline.operators.aggregates import avg_of, band_rate, daily_trend, kpi_by_dim, max_of, sum_of
from strandline.operators.clean import clean
from strandline.operators.joins import join_kpi
from strandline.plans.catalogue.inputs import (
    ADMISSIONS,
    READINGS,
    SNAPSHOTS,
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
from strandline.plans.hospital import medallion_run, refresh_gold
from strandline.schemas import AGE_BANDS, AGE_REST, HOSPITAL, VITALS
from strandline.session import at_once, scratch_path
from strandline.sources.zones import read_curated, table_path, write_csv, write_parquet
from strandline.streaming.readings import arriving, silver_exact


def silver_patients(spark: SparkSession, folder: str) -> DataFrame:
    return without_zone(clean(text_admissions(spark, folder), ADMISSIONS))


SILVER_PATIENTS = f"""
SELECT DISTINCT o_orderkey, {sql_int('o_custkey')} AS o_custkey, o_orderpriority,
       {sql_moment('o_orderdate')} AS o_orderdate, {sql_int('o_totalprice')} AS o_totalprice
FROM ({TEXT_ADMISSIONS}) WHERE o_orderkey IS NOT NULL
"""


def silver_vitals(spark: SparkSession, folder: str) -> DataFrame:
    return without_zone(clean(text_readings(spark, folder), READINGS))


SILVER_VITALS = f"""
SELECT DISTINCT l_orderkey, {sql_int('l_linenumber')} AS l_linenumber, l_linestatus,
       {sql_moment('l_shipdate')} AS l_shipdate, {sql_double('l_quantity')} AS l_quantity,
       {sql_double('l_discount')} AS l_discount, {sql_int('l_partkey')} AS l_partkey
FROM ({TEXT_READINGS}) WHERE l_orderkey IS NOT NULL
"""


def silver_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned, written partitioned, and read back in the declared column order."""
    zone = scratch_path(spark, "silver_operations")
    rows = clean(text_snapshots(spark, folder), SNAPSHOTS)
    write_parquet(rows, table_path(zone, SNAPSHOTS.name), SNAPSHOTS.partition_by)
    return without_zone(read_curated(spark, zone, SNAPSHOTS))


SILVER_OPERATIONS = f"""
SELECT DISTINCT event_id, {sql_moment('ts')} AS ts, {sql_int('user_id')} AS user_id, event_type,
       {sql_double('value')} AS value, CAST({sql_moment('ts')} AS DATE) AS day
FROM ({TEXT_SNAPSHOTS})
"""


def kpi_by_dim_query(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {
        "avg_value_pct": avg_of("value", 1, 100),
        "avg_value": avg_of("value", 1),
        "peak_user": max_of("user_id"),
    }
    return kpi_by_dim(given(spark, folder, "events"), ["event_type"], metrics, "avg_value_pct")


KPI_BY_DIM = """
SELECT event_type, ROUND(AVG(value) * 100, 1) AS avg_value_pct, ROUND(AVG(value), 1) AS avg_value,
       MAX(user_id) AS peak_user
FROM events GROUP BY event_type ORDER BY avg_value_pct DESC, event_type
"""


def _flagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = given(spark, folder, "lineitem")
    return lines.select(
        # with fractions, so that values lie between the whole bounds as well
        "l_linestatus", (F.col("l_quantity") + F.col("l_discount") * 10).alias("l_quantity"), flag(F.col("l_returnflag") == "R").alias("returned")
    )


def band_rate_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = _flagged_lines(spark, folder)
    return band_rate(
        lines, ["l_linestatus"], "l_quantity", AGE_BANDS, AGE_REST, "returned", ordered=True
    )


def band_rate_marginal(spark: SparkSession, folder: str) -> DataFrame:
    return band_rate(_flagged_lines(spark, folder), [], "l_quantity", AGE_BANDS, AGE_REST, "returned")


def _band_sql(dims: str) -> str:
    return f"""
SELECT {dims} CASE WHEN q < 18 THEN '0-17' WHEN q <= 40 THEN '18-40'
            WHEN q <= 65 THEN '41-65' ELSE '65+' END AS band,
       COUNT(*) AS total, CAST(SUM(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS positives,
       ROUND(AVG(CAST(l_returnflag = 'R' AS INTEGER)) * 100, 1) AS rate_pct
FROM (SELECT *, l_quantity + l_discount * 10 AS q FROM lineitem) GROUP BY ALL
"""


def join_kpi_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = given(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "order_key")
    orders = given(spark, folder, "orders").withColumnRenamed("o_orderkey", "order_key")
    measures = {
        "avg_quantity": ("l_quantity", 1, 1),
        "avg_discount_pct": ("l_discount", 2, 100),
        "avg_tax_pct": ("l_tax", 1, 100),
        "avg_line": ("l_linenumber", 0, 1),
    }
    return join_kpi(
        lines, orders, "order_key", "o_orderpriority", measures, order_by="avg_quantity"
    )


JOIN_KPI = """
SELECT o_orderpriority, COUNT(DISTINCT o_orderkey) AS parents,
       ROUND(AVG(l_quantity), 1) AS avg_quantity, ROUND(AVG(l_discount) * 100, 2) AS avg_discount_pct,
       ROUND(AVG(l_tax) * 100, 1) AS avg_tax_pct, ROUND(AVG(l_linenumber), 0) AS avg_line
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority ORDER BY avg_quantity DESC, o_orderpriority
"""


def daily_trend_query(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {
        "avg_value_pct": avg_of("value", 1, 100),
        "avg_value": avg_of("value", 1),
        "total_users": sum_of("user_id"),
    }
    return daily_trend(given(spark, folder, "events"), "ts", metrics)


DAILY_TREND = """
SELECT CAST(ts AS DATE) AS day, ROUND(AVG(value) * 100, 1) AS avg_value_pct,
       ROUND(AVG(value), 1) AS avg_value, CAST(SUM(user_id) AS BIGINT) AS total_users
FROM events GROUP BY 1 ORDER BY 1
"""


def hospital_rows(
    spark: SparkSession, folder: str, moment: Callable[[str], Column] = ts_text
) -> dict[str, DataFrame]:
    """The given tables in the shape of the hospital tables, as they come in Bronze.

    ``moment`` makes the event times, which are text unless it says otherwise.
    """
    orders, lines = given(spark, folder, "orders"), given(spark, folder, "lineitem")
    events = given(spark, folder, "events")
    patients = orders.select(
        F.col("o_orderkey").alias("patient_id"),
        F.floor(F.col("o_totalprice") / 5000).alias("age"),
        F.lit("F").alias("gender"),
        F.col("o_orderpriority").alias("department"),
        F.col("o_orderstatus").alias("admission_type"),
        F.col("o_orderstatus").alias("diagnosis"),
        moment("o_orderdate").alias("admission_ts"),
        ts_text("o_orderdate").alias("discharge_ts"),
        F.lit(1).alias("length_of_stay"),
        flag(F.col("o_orderstatus") == "F").alias("readmitted_30d"),
    )
    vitals = lines.select(
        F.col("l_suppkey").alias("device_id"),
        F.col("l_orderkey").alias("patient_id"),
        F.col("l_linestatus").alias("department"),
        moment("l_shipdate").alias("reading_ts"),
        F.col("l_quantity").alias("heart_rate"),
        F.col("l_discount").alias("spo2"),
        F.col("l_tax").alias("temperature"),
        F.col("l_linenumber").alias("bp_systolic"),
        F.col("l_linenumber").alias("bp_diastolic"),
    )
    operations = events.select(
        moment("ts").alias("snapshot_ts"),
        F.col("event_type").alias("department"),
        F.lit(100).alias("beds_total"),
        F.floor("value").alias("beds_occupied"),
        F.col("value").alias("occupancy_rate"),
        F.col("user_id").alias("patients_waiting"),
        F.floor("value").alias("avg_wait_minutes"),
    )
    return {"patients": patients, "vitals": vitals, "operations": operations}


def medallion_query(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch, fed with the given tables in the shape of the hospital tables.

    Returns the rows of the three Gold tables, and of Silver vitals, below one another.
    """
    base = scratch_path(spark, "medallion")
    bronze, silver, gold = (f"{base}/{zone}" for zone in ("bronze", "silver", "gold"))
    frames = hospital_rows(spark, folder)
    for name, df in frames.items():
        write_csv(df, table_path(bronze, name))
    medallion_run(spark, bronze, silver, gold)

    kpis = read_curated(spark, gold, "department_kpis").select(
        F.lit("department_kpis").alias("gold_table"),
        F.col("department").alias("key_1"),
        F.lit("").alias("key_2"),
        F.col("avg_occupancy_pct").alias("metric_1"),
        F.col("avg_wait_min").alias("metric_2"),
        F.col("peak_queue").cast("long").alias("metric_3"),
    )
    ages = read_curated(spark, gold, "readmission_by_age").select(
        F.lit("readmission_by_age").alias("gold_table"),
        F.col("department").alias("key_1"),
        F.col("age_group").alias("key_2"),
        F.col("readmit_rate_pct").alias("metric_1"),
        F.col("readmissions").cast("double").alias("metric_2"),
        F.col("total_patients").alias("metric_3"),
    )
    days = read_curated(spark, gold, "daily_trend").select(
        F.lit("daily_trend").alias("gold_table"),
        F.col("snapshot_date").cast("string").alias("key_1"),
        F.lit("").alias("key_2"),
        F.col("avg_occupancy_pct").alias("metric_1"),
        F.col("avg_wait_min").alias("metric_2"),
        F.col("total_waiting").alias("metric_3"),
    )
    vitals = read_curated(spark, silver, VITALS)
    readings = vitals.select(
        F.lit("silver_vitals").alias("gold_table"),
        F.concat_ws("|", "patient_id", "device_id", F.date_format("reading_ts", "yyyy-MM-dd HH:mm:ss")).alias("key_1"),
        F.concat_ws("|", "department", "bp_systolic", "bp_diastolic").alias("key_2"),
        F.col("heart_rate").alias("metric_1"),
        (F.col("spo2") + F.col("temperature")).alias("metric_2"),
        F.col("bp_systolic").cast("long").alias("metric_3"),
    )
    return kpis.unionByName(ages).unionByName(days).unionByName(readings)


MEDALLION = """
WITH ops AS (
  SELECT DISTINCT date_trunc('second', ts) AS snapshot_ts, event_type AS department,
         value AS occupancy_rate, user_id AS patients_waiting, floor(value) AS avg_wait_minutes
  FROM events),
ages AS (
  SELECT o_orderpriority AS department, CAST(o_orderstatus = 'F' AS INTEGER) AS readmitted,
         CASE WHEN floor(o_totalprice / 5000) < 18 THEN '0-17'
              WHEN floor(o_totalprice / 5000) <= 40 THEN '18-40'
              WHEN floor(o_totalprice / 5000) <= 65 THEN '41-65' ELSE '65+' END AS age_group
  FROM orders)
SELECT 'department_kpis' AS gold_table, department AS key_1, '' AS key_2,
       ROUND(AVG(occupancy_rate) * 100, 1) AS metric_1, ROUND(AVG(avg_wait_minutes), 1) AS metric_2,
       MAX(patients_waiting) AS metric_3
FROM ops GROUP BY department
UNION ALL
SELECT 'readmission_by_age', department, age_group, ROUND(AVG(readmitted) * 100, 1),
       CAST(SUM(readmitted) AS DOUBLE), COUNT(*)
FROM ages GROUP BY department, age_group
UNION ALL
SELECT 'daily_trend', strftime(snapshot_ts, '%Y-%m-%d'), '', ROUND(AVG(occupancy_rate) * 100, 1),
       ROUND(AVG(avg_wait_minutes), 1), CAST(SUM(patients_waiting) AS BIGINT)
FROM ops GROUP BY strftime(snapshot_ts, '%Y-%m-%d')
UNION ALL
SELECT 'silver_vitals', key_1, key_2, heart_rate, spo2 + temperature, bp
FROM (SELECT DISTINCT concat_ws('|', l_orderkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS key_1,
             concat_ws('|', l_linestatus, l_linenumber, l_linenumber) AS key_2, l_quantity AS heart_rate,
             l_discount AS spo2, l_tax AS temperature, CAST(l_linenumber AS BIGINT) AS bp
      FROM lineitem)
"""

# Days of the second arrival, which sends their odd rows, and their even ones once more. The
# other days of patients and vitals are quarters here, to have fewer of them.
LATER = {"patients": "dayofyear({day}) IN (40, 200)", "operations": "dayofmonth({day}) IN (3, 17)"}
LATER["vitals"] = LATER["patients"]


def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals by stream, with a refresh of Gold after each; the second has late rows and copies.

    Returns the rows of the four Gold tables below one another, and per Silver table the days
    that the second refresh read.
    """
    base = scratch_path(spark, "incremental")
    frames = hospital_rows(spark, folder, F.col)  # event times become text below, once
    arrivals = {}
    for name, ts, number in (
        ("patients", "admission_ts", "patient_id"),
        ("vitals", "reading_ts", "patient_id"),
        ("operations", "snapshot_ts", "patients_waiting"),
    ):
        rows, day = frames[name], F.to_date(ts)
        later = rows.withColumn("day", day).withColumn("later", F.expr(LATER[name].format(day="day")))
        moment = F.col(ts)
        if name != "operations":
            quarter = F.trunc(F.col("day"), "quarter")
            moment = F.when(F.col("later"), F.col("day")).otherwise(quarter).cast("timestamp")
        later = later.withColumn(ts, ts_text(moment))
        odd = F.pmod(F.col(number).cast("long"), F.lit(2)) == 1
        parts = later.where(~F.col("later") | ~odd), later.where("later")
        arrivals[name] = [part.select(*rows.columns) for part in parts]

    def arrive(name: str) -> None:
        arrived = f"{base}/arrived/{name}"
        write_csv(arrivals[name][turn], f"{arrived}/{turn}")
        stream = arriving(spark, arrived, HOSPITAL[name])
        silver_exact(stream, HOSPITAL[name], f"{base}/silver/{name}", f"{base}/state/{name}").awaitTermination()

    for turn in (0, 1):
        # the three tables at the same time, the largest first
        at_once(spark, arrive, ["vitals", "patients", "operations"])
        read = refresh_gold(spark, f"{base}/silver", f"{base}/states", f"{base}/gold")
    names = {
        "department_kpis": ("department", "''", "avg_occupancy_pct", "avg_wait_min", "peak_queue"),
        "readmission_by_age": ("department", "age_group", "readmit_rate_pct", "readmissions", "total_patients"),
        "vitals_by_admission_type": ("admission_type", "''", "avg_heart_rate", "avg_systolic_bp", "patients"),
        "daily_trend": ("CAST(snapshot_date AS STRING)", "''", "avg_occupancy_pct", "avg_wait_min", "total_waiting"),
    }
    out = spark.createDataFrame(
        [("refreshed", name, "", None, None, days) for name, days in read.items()],
        "gold_table string, key_1 string, key_2 string, metric_1 double, metric_2 double, metric_3 long",
    )
    for name, columns in names.items():
        key_1, key_2, one, two, three = columns
        out = out.unionByName(
            read_curated(spark, f"{base}/gold", name).selectExpr(
                f"'{name}' AS gold_table", f"{key_1} AS key_1", f"{key_2} AS key_2", f"CAST({one} AS DOUBLE) AS metric_1",
                f"CAST({two} AS DOUBLE) AS metric_2", f"CAST({three} AS BIGINT) AS metric_3",
            )
        )
    return out


GOLD_INCREMENTAL = f"""
{MEDALLION[: MEDALLION.index("UNION ALL\nSELECT 'silver_vitals'")]}
UNION ALL
SELECT 'vitals_by_admission_type', o_orderstatus, '', ROUND(AVG(heart_rate), 1), ROUND(AVG(bp), 0),
       COUNT(DISTINCT l_orderkey)
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linestatus, l_quantity AS heart_rate, l_discount, l_tax, l_linenumber AS bp,
             CASE WHEN {LATER['vitals'].format(day='l_shipdate')} THEN CAST(l_shipdate AS DATE)
                  ELSE CAST(date_trunc('quarter', l_shipdate) AS DATE) END AS day FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus
{"".join(
    f"""UNION ALL
SELECT 'refreshed', '{name}', '', NULL, NULL,
       COUNT(DISTINCT CAST({ts} AS DATE)) FILTER ({LATER[name].format(day=ts)} AND {number} % 2 = 1)
FROM {table}
"""
    for name, ts, number, table in (
        ("patients", "o_orderdate", "o_orderkey", "orders"),
        ("vitals", "l_shipdate", "l_orderkey", "lineitem"),
        ("operations", "ts", "user_id", "events"),
    )
)}"""

ENTRIES = {
    "silver_patients": (silver_patients, SILVER_PATIENTS),
    "silver_vitals": (silver_vitals, SILVER_VITALS),
    "silver_operations": (silver_operations, SILVER_OPERATIONS),
    "kpi_by_dim": (kpi_by_dim_query, KPI_BY_DIM),
    "band_rate": (band_rate_query, _band_sql("l_linestatus,")),
    "band_rate_marginal": (band_rate_marginal, _band_sql("")),
    "join_kpi": (join_kpi_query, JOIN_KPI),
    "daily_trend": (daily_trend_query, DAILY_TREND),
    "medallion_run": (medallion_query, MEDALLION),
    "gold_incremental": (gold_incremental, GOLD_INCREMENTAL),
}

"""Joins, row generation, aggregates, distinct and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.aggregates import (
    avg_of,
    distinct_of,
    kpi_by_dim,
    max_of,
    profile,
    rate_of,
    rows,
    sum_of,
    top_k,
)
from strandline.operators.joins import expand_children, join_dealt, lookup, time_spine
from strandline.plans.catalogue.inputs import given


def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nations = given(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    found = lookup(given(spark, folder, "customer"), nations, "c_nationkey")
    return found.select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


DIM_LOOKUP = """
SELECT c_custkey, c_nationkey, n_name, n_regionkey
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""


def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = given(spark, folder, "lineitem"), given(spark, folder, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderpriority", "o_custkey")


JOIN_INNER = """
SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority, o_custkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def join_dealt_query(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which a third have one order, and some have none, with their order if there is one."""
    lines, orders = given(spark, folder, "lineitem"), given(spark, folder, "orders")
    key = F.when(F.col("l_partkey") % 3 == 0, 1).when(F.col("l_partkey") % 7 != 0, F.col("l_orderkey"))
    moved = lines.select("l_orderkey", "l_linenumber", key.cast("long").alias("o_orderkey"))
    return join_dealt(moved, orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", "left")


JOIN_DEALT = """
SELECT l_orderkey, l_linenumber, moved.o_orderkey, o_custkey, o_totalprice
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_partkey % 3 = 0 THEN 1 WHEN l_partkey % 7 <> 0 THEN l_orderkey END AS o_orderkey
      FROM lineitem) AS moved
LEFT JOIN orders ON moved.o_orderkey = orders.o_orderkey
"""


def time_spine_query(spark: SparkSession, folder: str) -> DataFrame:
    events = given(spark, folder, "events")
    start = events.agg(F.date_trunc("hour", F.min("ts"))).scalar()
    end = events.agg(F.date_trunc("hour", F.max("ts"))).scalar()
    spine = time_spine(events.select("event_type").distinct(), start, end)
    return spine.select("event_type", F.col("snapshot_ts").cast("timestamp_ntz").alias("snapshot_ts"))


TIME_SPINE = """
SELECT event_type, UNNEST(generate_series(lo, hi, INTERVAL 1 HOUR)) AS snapshot_ts
FROM (SELECT DISTINCT event_type FROM events)
CROSS JOIN (SELECT date_trunc('hour', MIN(ts)) AS lo, date_trunc('hour', MAX(ts)) AS hi FROM events)
"""


def expand_children_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    children = expand_children(orders, F.floor(F.col("o_totalprice") / 50000), "reading_no")
    return children.select("o_orderkey", "o_orderpriority", "reading_no")


EXPAND_CHILDREN = """
SELECT o_orderkey, o_orderpriority,
       UNNEST(generate_series(1, GREATEST(1, CAST(floor(o_totalprice / 50000) AS BIGINT)))) AS reading_no
FROM orders
"""


def agg_avg(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {"avg_quantity": avg_of("l_quantity", 2), "avg_discount_pct": avg_of("l_discount", 2, 100)}
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_returnflag"], metrics)


def agg_max(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {"max_price": max_of("l_extendedprice"), "last_ship": max_of("l_shipdate")}
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_suppkey"], metrics)


def agg_sum(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {"lines": sum_of("l_linenumber"), "quantity": sum_of("l_quantity")}
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_suppkey"], metrics)


def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_partkey"], {"n": rows()})


def agg_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {
        "parts": distinct_of("l_partkey"),
        "avg_quantity": avg_of("l_quantity", 2),
        "n": rows(),
    }
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_returnflag"], metrics)


AGG_COUNT_DISTINCT = """
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, ROUND(AVG(l_quantity), 2) AS avg_quantity,
       COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag
"""


def flag_rate(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {
        "returned_rate": F.round(rate_of(F.col("l_returnflag") == "R"), 4),
        "large_rate": F.round(rate_of(F.col("l_quantity") > 40), 4),
    }
    return kpi_by_dim(given(spark, folder, "lineitem"), ["l_linestatus"], metrics)


FLAG_RATE = """
SELECT l_linestatus, ROUND(AVG(CAST(l_returnflag = 'R' AS INTEGER)), 4) AS returned_rate,
       ROUND(AVG(CAST(l_quantity > 40 AS INTEGER)), 4) AS large_rate
FROM lineitem GROUP BY l_linestatus
"""


def profile_query(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: given(spark, folder, name) for name in ("orders", "lineitem", "events")}
    rates = {
        "orders": {"urgent_rate": F.col("o_orderpriority") == "1-URGENT"},
        "lineitem": {"returned_rate": F.col("l_returnflag") == "R"},
    }
    return profile(tables, rates)


PROFILE = """
SELECT 'orders' AS table_name, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'orders', 'urgent_rate', ROUND(AVG(CAST(o_orderpriority = '1-URGENT' AS INTEGER)), 3) FROM orders
UNION ALL SELECT 'lineitem', 'rows', CAST(COUNT(*) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'lineitem', 'returned_rate', ROUND(AVG(CAST(l_returnflag = 'R' AS INTEGER)), 3) FROM lineitem
UNION ALL SELECT 'events', 'rows', CAST(COUNT(*) AS DOUBLE) FROM events
"""


def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = given(spark, folder, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount").dropDuplicates()


def top_k_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, "o_totalprice", 12, ["o_orderkey"])


ENTRIES = {
    "dim_lookup": (dim_lookup, DIM_LOOKUP),
    "join_inner": (join_inner, JOIN_INNER),
    "join_dealt": (join_dealt_query, JOIN_DEALT),
    "time_spine": (time_spine_query, TIME_SPINE),
    "expand_children": (expand_children_query, EXPAND_CHILDREN),
    "agg_avg": (
        agg_avg,
        """SELECT l_returnflag, ROUND(AVG(l_quantity), 2) AS avg_quantity,
                  ROUND(AVG(l_discount) * 100, 2) AS avg_discount_pct
           FROM lineitem GROUP BY l_returnflag""",
    ),
    "agg_max": (
        agg_max,
        """SELECT l_suppkey, MAX(l_extendedprice) AS max_price, MAX(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_suppkey""",
    ),
    "agg_sum": (
        agg_sum,
        """SELECT l_suppkey, CAST(SUM(l_linenumber) AS BIGINT) AS lines, SUM(l_quantity) AS quantity
           FROM lineitem GROUP BY l_suppkey""",
    ),
    "agg_count": (agg_count, "SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY l_partkey"),
    "agg_count_distinct": (agg_count_distinct, AGG_COUNT_DISTINCT),
    "flag_rate": (flag_rate, FLAG_RATE),
    "profile": (profile_query, PROFILE),
    "dedupe_rows": (
        dedupe_rows,
        "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem",
    ),
    "top_k": (
        top_k_query,
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 12",
    ),
}

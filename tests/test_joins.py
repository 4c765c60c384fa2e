from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandline.operators import joins as J
from strandline.session import settings
from tests.conftest import plan, rows

MEASURES = {"m": ("v", 4, 1), "pct": ("v", 2, 100)}


def direct(children, parents):
    """The same result in the plain way: join every row, then aggregate."""
    return (
        children.join(parents, "k")
        .groupBy("d")
        .agg(
            F.countDistinct("k").alias("parents"),
            F.round(F.avg("v"), 4).alias("m"),
            F.round(F.avg("v") * 100, 2).alias("pct"),
        )
    )


def test_join_kpi_equals_the_plain_join(spark):
    children = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", None), ("b", 8.0), (None, 5.0), ("x", 9.0), ("c", None)],
        "k string, v double",
    )
    # "a" twice with one attribute and once with another, "e" has no reading
    parents = spark.createDataFrame(
        [("a", "E"), ("a", "E"), ("a", "P"), ("b", "P"), ("c", None), (None, "E"), ("e", "P")],
        "k string, d string",
    )
    got = J.join_kpi(children, parents, "k", "d", MEASURES)
    assert rows(got) == rows(direct(children, parents))


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_join_kpi_with_one_key_holding_a_third(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
        children = spark.range(30000).select(key.alias("k"), (F.col("id") % 10).cast("double").alias("v"))
        parents = spark.range(1200).select(
            (F.col("id") % 1100).alias("k"), (F.col("id") % 2).cast("string").alias("d")
        )
        got = J.join_kpi(children, parents, "k", "d", MEASURES, order_by="m")
        assert rows(got) == rows(direct(children, parents))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_children_are_reduced_before_the_join(spark):
    children = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("v"))
    parents = spark.range(5).select(F.col("id").alias("k"), F.lit("E").alias("d"))
    text = plan(J.join_kpi(children, parents, "k", "d", MEASURES))
    assert "partial_sum(v" in text[text.index("Join"):]


def test_lookup_broadcasts_only_within_the_bound(spark):
    facts = spark.range(100).select((F.col("id") % 7).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    assert "BroadcastHashJoin" in plan(J.lookup(facts, dim, "k"))
    assert J.lookup(facts, dim, "k").where("name is null").count() == 100 - J.lookup(
        facts, dim, "k"
    ).where("name is not null").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = J.join_checked(facts, dim, "k", "left", max_bytes=4)
        assert "BroadcastHashJoin" not in plan(beyond)
        assert rows(beyond) == rows(J.join_checked(facts, dim, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_time_spine_has_every_step_and_no_join(spark):
    dims = spark.createDataFrame([("a",), ("b",)], "d string")
    start, end = F.lit(datetime(2025, 1, 1)), F.lit(datetime(2025, 1, 3, 23))
    got = J.time_spine(dims, start, end)
    assert got.count() == 2 * 72 == got.distinct().count()
    assert "Join" not in plan(got)


def test_expand_children(spark):
    data = [("a", 3), ("b", 0), ("c", None), ("d", 10)]
    df = spark.createDataFrame(data, "k string, n int")
    want = sorted(
        [(k, n, i) for k, n in data for i in range(1, max(1, n or 1) + 1)], key=repr
    )
    for chunk in (100, 4, 3, 1):
        assert rows(J.expand_children(df, "n", chunk=chunk)) == want


def test_children_come_from_one_scan(spark):
    df = spark.range(10).withColumn("n", F.col("id") * 3)
    text = plan(J.expand_children(df, "n", chunk=4))
    assert text.count("Range (") == 1 and "Union" not in text


def test_a_nondeterministic_number_of_children_loses_no_parent(spark):
    df = spark.range(200).withColumn("n", (F.rand() * 9).cast("int"))
    got = J.expand_children(df, "n", chunk=4).groupBy("id").agg(F.count("*").alias("k"), F.max("child_no").alias("m"))
    assert got.where("k = m").count() == 200


# --- a join whose hot keys are dealt out ---


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dealt_join_equals_the_plain_join(spark, how):
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL WHEN id % 5 = 0 THEN 5000 ELSE id % 400 END"
    big = spark.range(6000).selectExpr(f"{key} AS k", "id AS v", "1 AS n")
    # keys twice, keys that are missing, a null
    small = spark.range(700).selectExpr("CASE WHEN id = 3 THEN NULL ELSE id % 350 END AS k", "id AS w")
    got = J.join_dealt(big, small, "k", how, parts=16)
    want = big.join(small, "k", how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_dealt_join_of_empty_sides(spark):
    big, small = spark.range(9).selectExpr("id AS k", "id AS v"), spark.range(9).selectExpr("id AS k", "id AS w")
    none = F.lit(False)
    assert J.join_dealt(big.where(none), small, "k").count() == 0
    assert J.join_dealt(big, small.where(none), "k", "left").count() == 9
    only_nulls = big.withColumn("k", F.lit(None).cast("long"))
    assert J.join_dealt(only_nulls, small, "k", "left").count() == 9
    with pytest.raises(ValueError, match="more than once"):
        J.join_dealt(big, small, "k", "full")


def test_a_key_with_a_third_of_the_rows_is_spread(spark):
    """No task gets twice the median, although the optimizer may split nothing."""
    conf = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    with settings(spark, conf):
        key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id % 40000 END"
        big = spark.range(240_000, numPartitions=8).selectExpr(f"{key} AS k", "id AS v")
        small = spark.range(40_000).selectExpr("id AS k", "id AS w")

        def per_task(df):
            counts = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
            return sorted(r["count"] for r in counts)

        plain, dealt = per_task(big.join(small, "k", "left")), per_task(J.join_dealt(big, small, "k", "left"))
        assert plain[-1] > 4 * plain[8]
        assert len(dealt) == 16 and dealt[-1] <= 2 * dealt[8] and sum(dealt) == sum(plain)

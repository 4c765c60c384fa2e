from datetime import date, datetime

from pyspark.sql import functions as F

from strandline.operators import aggregates as A
from strandline.schemas import AGE_BANDS, AGE_REST
from tests.conftest import plan, rows


def test_rate_is_over_known_flags_and_total_over_all(spark):
    df = spark.createDataFrame([("x", 30, 1), ("x", 30, 0), ("x", 30, None)], "d string, age int, f int")
    assert rows(A.band_rate(df, ["d"], "age", AGE_BANDS, AGE_REST, "f")) == [("x", "18-40", 3, 1, 50.0)]


def test_band_rate_without_dimensions(spark):
    df = spark.createDataFrame([(10, 1), (70, 0), (None, 1)], "age int, f int")
    got = A.band_rate(df, [], "age", AGE_BANDS, AGE_REST, "f")
    assert rows(got) == [("0-17", 1, 1, 100.0), ("65+", 2, 1, 50.0)]


def test_kpis_are_ordered_with_ties_by_dimension_and_nulls_last(spark):
    data = [("b", 2.0), ("a", 2.0), ("c", 3.0), ("d", None)]
    df = spark.createDataFrame(data, "d string, v double")
    got = A.kpi_by_dim(df, ["d"], {"m": A.avg_of("v", 1)}, order_by="m").collect()
    assert [r.d for r in got] == ["c", "a", "b", "d"]


def test_all_metrics(spark):
    data = [("a", 1, 0.5), ("a", 1, None), ("a", 3, 1.0)]
    df = spark.createDataFrame(data, "d string, k int, v double")
    metrics = {
        "mean": A.avg_of("v", 1, 100),
        "top": A.max_of("k"),
        "total": A.sum_of("k"),
        "n": A.rows(),
        "keys": A.distinct_of("k"),
        "about": A.distinct_of("k", approximate=True),
        "rate": A.rate_of(F.col("k") > 1),
    }
    (row,) = A.kpi_by_dim(df, ["d"], metrics).collect()
    assert tuple(row)[1:7] == (75.0, 3, 5, 3, 2, 2)
    assert abs(row.rate - 1 / 3) < 1e-12


def test_days_are_ascending_and_unknown_last(spark):
    data = [(datetime(2025, 1, 2, 1), 1), (None, 5), (datetime(2025, 1, 1, 23), 2), (datetime(2025, 1, 2, 9), 3)]
    df = spark.createDataFrame(data, "ts timestamp, v int")
    got = A.daily_trend(df, "ts", {"v": A.sum_of("v")}).collect()
    assert [tuple(r) for r in got] == [(date(2025, 1, 1), 2), (date(2025, 1, 2), 4), (None, 5)]


def test_profile(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "f int")
    got = A.profile({"one": df, "two": df.limit(0)}, {"one": {"rate": F.col("f") == 1}})
    assert rows(got) == [("one", "rate", 0.333), ("one", "rows", 3.0), ("two", "rows", 0.0)]


def test_top_k_and_preview_keep_k_rows_per_task(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    got = A.top_k(df, "v", 3, ["id"])
    assert [tuple(r) for r in got.collect()] == [(6, 6), (13, 6), (20, 6)]
    assert "TakeOrderedAndProject" in plan(got)
    assert [r.id for r in A.preview(df, 2, "id").collect()] == [0, 1]
    assert A.preview(df, 2).count() == 2


def test_a_hot_group_is_merged_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("d"), F.col("id").alias("v"))
    text = plan(A.kpi_by_dim(df, ["d"], {"m": A.avg_of("v")}))
    assert "partial_avg" in text

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandline.functions import columns as C
from strandline.schemas import AGE_BANDS, AGE_REST
from strandline.sources.sql_text import register_functions


def values(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_text_to_int_goes_through_double(spark):
    data = [("72",), ("2.9",), ("-2.9",), (" 7 ",), ("abc",), ("",), (None,), ("3000000000",), ("NaN",)]
    assert values(spark, data, "x string", C.to_int("x")) == [72, 2, -2, 7, None, None, None, None, None]


def test_text_to_double(spark):
    data = [("72.0",), ("abc",), (None,)]
    assert values(spark, data, "x string", C.to_double("x")) == [72.0, None, None]


def test_timestamps_by_both_patterns(spark):
    data = [("2031-05-02 08:30:00",), ("n/a",), ("2031-13-01 00:00:00",), (None,)]
    want = [datetime(2031, 5, 2, 8, 30), None, None, None]
    assert values(spark, data, "x string", C.to_moment("x")) == want
    assert values(spark, data, "x string", C.to_moment_percent("x", "%Y-%m-%d %H:%i:%s")) == want


def test_band_edges(spark):
    ages = [(17,), (18,), (40,), (41,), (65,), (66,), (None,)]
    want = ["0-17", "18-40", "18-40", "41-65", "41-65", "65+", "65+"]
    assert values(spark, ages, "x int", C.band("x", AGE_BANDS, AGE_REST)) == want


def test_band_edges_between_whole_numbers(spark):
    ages = [(17.5,), (17.999,), (40.2,), (65.5,)]
    assert values(spark, ages, "x double", C.band("x", AGE_BANDS, AGE_REST)) == ["0-17", "0-17", "41-65", "65+"]


def test_percent_patterns_with_letters_and_other_fields(spark):
    register_functions(spark)
    data = [("02.05.31 at 8:30 o'clock PM",)]
    pattern = "%d.%m.%y at %l:%i o'clock %p"
    want = [datetime(2031, 5, 2, 20, 30)]
    assert values(spark, data, "x string", C.to_moment_percent("x", pattern)) == want
    for text, pattern in (("2031-05-02T08:30:07", "%Y-%m-%dT%T"), ("100% 2 May 2031", "100%% %e %b %Y")):
        got = values(spark, [(text,)], "x string", C.to_moment_percent("x", pattern))
        assert got[0] is not None
        assert values(spark, [(text,)], "x string", F.expr(f"date_parse(x, '{pattern}')")) == got


def test_an_unknown_percent_field_is_an_error(spark):
    register_functions(spark)
    with pytest.raises(ValueError, match="%X"):
        C.java_pattern("%Y %X")
    with pytest.raises(Exception, match="unknown date field"):
        values(spark, [("2031",)], "x string", F.expr("date_parse(x, '%Y %X')"))


def test_rounding_is_half_up_on_both_sides_of_zero(spark):
    assert values(spark, [(2.25,), (-2.25,)], "x double", F.round("x", 1)) == [2.3, -2.3]


def test_percent_scales_before_rounding(spark):
    assert values(spark, [(0.7846,)], "x double", C.percent("x")) == [78.5]


def test_ratio_of_zero_is_null(spark):
    data = [(1, 4), (1, 0), (None, 2)]
    assert values(spark, data, "a int, b int", C.ratio("a", "b")) == [0.25, None, None]
    assert values(spark, [(2, 3)], "a int, b int", C.ratio("a", "b", 3)) == [0.667]


def test_clamp_keeps_null(spark):
    data = [(5.0,), (50.0,), (500.0,), (None,)]
    assert values(spark, data, "x double", C.clamp("x", 10.0, 100.0)) == [10.0, 50.0, 100.0, None]
    assert values(spark, data, "x double", C.clamp("x", low=10.0)) == [10.0, 50.0, 500.0, None]
    assert values(spark, data, "x double", C.clamp("x", high=100.0)) == [5.0, 50.0, 100.0, None]


def test_trunc_cuts_toward_zero(spark):
    assert values(spark, [(2.9,), (-2.9,), (None,)], "x double", C.trunc_int("x")) == [2, -2, None]


def test_flag_and_label(spark):
    data = [(1,), (2,), (None,)]
    assert values(spark, data, "x int", C.flag(F.col("x") == 1)) == [1, 0, 0]
    assert values(spark, data, "x int", C.either(F.col("x") == 1, "a", "b")) == ["a", "b", "b"]


def test_rule_score_adds_and_caps(spark):
    score = C.rule_score("c", {"a": 0.2, "b": 0.55}, [(F.col("x") > 70, 0.15)], cap=0.65)
    data = [("a", 80), ("a", 70), ("b", 80), ("z", 80), ("a", None)]
    got = values(spark, data, "c string, x int", F.round(score, 6))
    assert got == [0.35, 0.2, 0.65, None, 0.2]


def test_padded_id_keeps_long_numbers(spark):
    got = values(spark, [(7,), (123456,)], "x int", C.padded_id("x", "P", 5))
    assert got == ["P00007", "P123456"]


def test_time_shift_and_text(spark):
    data = [(datetime(2025, 1, 31, 23, 30), 2)]
    shifted = C.add_time("t", days=F.col("n"), hours=1, minutes=45)
    assert values(spark, data, "t timestamp, n int", C.ts_text(shifted)) == ["2025-02-03 01:15:00"]


@pytest.mark.parametrize("hour", [0, 6, 12, 18])
def test_diurnal_factor(spark, hour):
    got = values(spark, [(datetime(2025, 1, 1, hour, 59),)], "t timestamp", C.diurnal_factor("t"))[0]
    assert got == pytest.approx(1 + 0.4 * math.sin((hour - 6) / 24 * 2 * math.pi), abs=1e-12)

from strandline.operators.clean import clean, typed
from strandline.schemas import OPERATIONS, PATIENTS, VITALS
from tests.conftest import plan

TS = "2031-05-02 08:30:00"


def vitals(spark, *data):
    return spark.createDataFrame(list(data), VITALS.bronze_schema)


def test_copies_are_merged_after_the_casts(spark):
    df = vitals(
        spark,
        ("D1", "P1", "General", TS, "64", "98.1", "36.5", "118", "77"),
        ("D1", "P1", "General", TS, "64.0", "98.10", "36.5", "118.0", " 77"),
        ("D1", "P1", "General", TS, "65", "98.1", "36.5", "118", "77"),
    )
    got = clean(df, VITALS)
    assert sorted(r.heart_rate for r in got.collect()) == [64.0, 65.0]
    assert got.schema.simpleString() == VITALS.silver_schema.simpleString()


def test_rows_without_patient_go_and_bad_values_stay_as_null(spark):
    df = vitals(
        spark,
        ("D1", None, "General", TS, "64", "98.1", "36.5", "118", "77"),
        ("D1", "P1", "General", "later", "abc", "", None, "x", "77"),
    )
    (row,) = clean(df, VITALS).collect()
    assert (row.patient_id, row.reading_ts, row.heart_rate, row.bp_systolic) == ("P1", None, None, None)
    assert row.bp_diastolic == 77


def test_operations_keep_rows_without_a_key(spark):
    data = [("2025-01-01 05:00:00", None, "40", "20", "0.5", "0", "29"), (None,) * 7]
    got = clean(spark.createDataFrame(data, OPERATIONS.bronze_schema), OPERATIONS).collect()
    assert len(got) == 2
    assert {str(r.snapshot_date) for r in got} == {"2025-01-01", "None"}


def test_text_int_with_fraction(spark):
    data = [("P1", "2.9", "F", "General", "Planned", "Asthma", TS, TS, "3", "1")]
    (row,) = clean(spark.createDataFrame(data, PATIENTS.bronze_schema), PATIENTS).collect()
    assert row.age == 2


def test_cleaning_is_one_shuffle_with_map_side_merge(spark):
    df = spark.createDataFrame([], VITALS.bronze_schema)
    text = plan(clean(df, VITALS))
    assert text.count("Exchange hashpartitioning") <= 1
    assert "Python" not in plan(typed(df, VITALS))

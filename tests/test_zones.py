import csv

import pytest
from pyspark.sql import functions as F

from strandline.plans.hospital import department_kpis
from strandline.schemas import HOSPITAL, OPERATIONS
from strandline.sources.sql_text import run_sql
from strandline.sources.zones import (
    read_curated,
    register_zone,
    scan_csv,
    table_path,
    write_csv,
    write_json,
    write_parquet,
)
from tests.conftest import plan, rows

PATIENT = "P1,70,F,General,Planned,Asthma,2025-01-01 10:00:00,2025-01-03 10:00:00,2,1"
OPERATION = "2025-01-01 05:00:00,General,50,25,0.5,3,20"


@pytest.fixture()
def bronze(tmp_path):
    """A Bronze zone with one row in two of its tables."""
    for name, line in (("patients", PATIENT), ("operations", OPERATION)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part.csv").write_text(",".join(HOSPITAL[name].columns) + "\n" + line + "\n")
    return str(tmp_path)


def test_csv_round_trip_keeps_quotes_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([('{"k": "a,b"}', 1.5), (None, None)], "a string, b double")
    write_csv(df, str(tmp_path / "t"))
    assert rows(scan_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)
    inferred = scan_csv(spark, str(tmp_path / "t"), infer=True)
    assert inferred.dtypes == [("a", "string"), ("b", "double")]
    assert scan_csv(spark, str(tmp_path / "t")).dtypes == [("a", "string"), ("b", "string")]


def test_text_goes_out_with_its_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" 72 ", "a"), (None, "c")], "a string, b string")
    write_csv(df, str(tmp_path / "t"))
    assert rows(scan_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_a_file_with_other_columns_fails(spark, tmp_path):
    write_csv(spark.createDataFrame([("x", "y")], "b string, a string"), str(tmp_path / "t"))
    df = scan_csv(spark, str(tmp_path / "t"), "a string, b string")
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_writes_replace_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "d string, v int")
    write_parquet(two, path, ["d"])
    assert rows(spark.read.parquet(path).select("d", "v")) == rows(two)
    write_parquet(two.where("d = 'b'"), path, ["d"])
    assert rows(spark.read.parquet(path).select("d", "v")) == [("b", 2)]


def test_a_large_partition_is_spread_over_files(spark, tmp_path):
    """One department with nearly all rows is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        department = F.when(F.col("id") % 100 == 0, "small").otherwise("hot")
        df = spark.range(0, 200000, 1, 8).select(department.alias("d"), F.rand(1).alias("v"))
        write_parquet(df, str(tmp_path / "t"), ["d"])
        hot = list((tmp_path / "t" / "d=hot").glob("*.parquet"))
        small = list((tmp_path / "t" / "d=small").glob("*.parquet"))
        assert len(hot) > 1 and len(small) == 1
        assert spark.read.parquet(str(tmp_path / "t")).count() == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_partition_column_returns_to_its_place(spark, tmp_path):
    schema = OPERATIONS.silver_schema
    df = spark.createDataFrame([(None, "General", 50, 25, 0.5, 3, 20, None)], schema)
    write_parquet(df, table_path(str(tmp_path), "operations"), ["department"])
    assert read_curated(spark, str(tmp_path), OPERATIONS).columns == schema.names


def test_curated_reads_prune_partitions_and_columns(spark, tmp_path):
    schema = OPERATIONS.silver_schema
    df = spark.createDataFrame([(None, "General", 50, 25, 0.5, 3, 20, None)], schema)
    write_parquet(df, table_path(str(tmp_path), "operations"), ["department"])
    operations = read_curated(spark, str(tmp_path), OPERATIONS)
    text = plan(operations.where("department = 'General' and beds_total > 10").select("beds_total"))
    assert "PartitionFilters: [isnotnull(department" in text
    assert "GreaterThan(beds_total,10)" in text and "ReadSchema: struct<beds_total:int>" in text
    text = plan(department_kpis(operations))
    assert "ReadSchema: struct<occupancy_rate:double,patients_waiting:int,avg_wait_minutes:int>" in text


def test_registering_as_views(spark, bronze):
    found = register_zone(spark, bronze, "csv")
    types = {(r.table_name, r.column_name): r.data_type for r in found.collect()}
    assert types["patients", "age"] == "int" and types["operations", "snapshot_ts"] == "string"
    assert spark.table("patients").count() == 1


def test_unknown_folders_are_inferred(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, "x")], "n int, s string"), str(tmp_path / "zone" / "extra"))
    found = register_zone(spark, str(tmp_path / "zone"), "csv")
    assert [(r.column_name, r.data_type) for r in found.orderBy("position").collect()] == [
        ("n", "int"),
        ("s", "string"),
    ]


def test_sql_over_a_registered_database(spark, bronze, tmp_path):
    register_zone(spark, bronze, "csv", database="wards")
    text = """
        SELECT department, min(date_parse(snapshot_ts, '%Y-%m-%d %T')) AS first_seen,
               max(beds_total - beds_occupied) AS most_free
        FROM operations GROUP BY department ORDER BY department NULLS LAST;
    """
    before = spark.catalog.currentDatabase()
    got = run_sql(spark, text, database="wards", output=str(tmp_path / "result"))
    assert [(d, str(t), n) for d, t, n in rows(got)] == [("General", "2025-01-01 05:00:00", 25)]
    assert spark.catalog.currentDatabase() == before
    assert rows(run_sql(spark, "SELECT age FROM patients LIMIT 10", database="wards")) == [(70,)]
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        run_sql(spark, "SELEC 1")


def test_stored_results_keep_order_and_nested_values(spark, tmp_path):
    text = "SELECT id, array(id, NULL) AS pair, '' AS nothing FROM range(0, 400000, 1, 7) ORDER BY id DESC"
    got = run_sql(spark, text, output=str(tmp_path / "r"))
    assert got.columns == ["id", "pair", "nothing"]
    assert [r.id for r in got.collect()] == list(range(399_999, -1, -1))
    assert tuple(got.first()) == (399_999, [399_999, None], "")
    flat = run_sql(spark, "SELECT 'a\nb' AS x, '' AS y, CAST(NULL AS INT) AS z", output=str(tmp_path / "c"), form="csv")
    assert rows(flat) == [("a\nb", "", None)]


def test_csv_of_another_writer(spark, tmp_path):
    data = [('say ""hi"", ok', "1"), ('"', "a\\"), ("one\ntwo\r\nthree", ","), ("", "x"), (" ", "'")]
    (tmp_path / "t").mkdir()
    with (tmp_path / "t" / "x.csv").open("w", newline="") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL)
        writer.writerow(["a", "b"])
        writer.writerows(data)
    got = scan_csv(spark, str(tmp_path / "t"), "a string, b string", multiline=True)
    assert rows(got) == sorted([(a.replace("\r\n", "\n"), b) for a, b in data], key=repr) or rows(got) == sorted(data, key=repr)
    write_csv(got, str(tmp_path / "back"), multiline=True)
    read = []
    for part in (tmp_path / "back").glob("*.csv"):
        with part.open(newline="") as file:
            read += list(csv.reader(file))[1:]
    assert sorted(map(tuple, read), key=repr) == rows(got)


def test_empty_text_and_null_are_kept_apart(spark, tmp_path):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", None)], "a string, b int")
    write_csv(df, str(tmp_path / "t"))
    assert rows(scan_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_a_line_break_needs_a_multiline_table(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1)], "a string, b int")
    with pytest.raises(Exception, match="line break"):
        write_csv(df, str(tmp_path / "t"))
    write_csv(df, str(tmp_path / "m"), multiline=True)
    assert rows(scan_csv(spark, str(tmp_path / "m"), df.schema, multiline=True)) == rows(df)


def test_a_managed_table_is_not_dropped(spark, bronze):
    spark.sql("CREATE DATABASE IF NOT EXISTS owned")
    spark.sql("CREATE TABLE owned.patients USING parquet AS SELECT 1 AS a UNION ALL SELECT 2")
    with pytest.raises(ValueError, match="managed"):
        register_zone(spark, bronze, "csv", database="owned")
    assert spark.table("owned.patients").count() == 2
    spark.sql("DROP TABLE owned.patients")
    for _ in range(2):  # external ones are registered anew
        register_zone(spark, bronze, "csv", database="owned")
    assert spark.table("owned.patients").count() == 1


def test_registering_partitioned_parquet_in_a_database(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "d string, v int")
    write_parquet(df, str(tmp_path / "zone" / "parts"), ["d"])
    register_zone(spark, str(tmp_path / "zone"), "parquet", database="wards2")
    assert rows(run_sql(spark, "SELECT d, v FROM parts", database="wards2")) == rows(df)


def test_json_document(spark, tmp_path):
    df = spark.sql("SELECT named_struct('a', 1, 'b', array(1, 2)) AS doc")
    write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)


def test_only_ordered_results_are_sorted_on_reading(spark, tmp_path):
    spark.range(50).createOrReplaceTempView("some_ids")
    plain = run_sql(spark, "SELECT id % 5 AS k, COUNT(*) AS n FROM some_ids GROUP BY 1", output=str(tmp_path / "plain"))
    assert plain.columns == ["k", "n"] and "Sort" not in plan(plain) and plain.count() == 5
    assert "_row" not in spark.read.parquet(str(tmp_path / "plain")).columns
    for i, text in enumerate(("SELECT id FROM some_ids ORDER BY id % 7, id DESC", "SELECT id FROM some_ids ORDER BY id % 7, id DESC LIMIT 9")):
        ordered = run_sql(spark, text, output=str(tmp_path / str(i)))
        assert [r["id"] for r in ordered.collect()] == [r["id"] for r in spark.sql(text).collect()]

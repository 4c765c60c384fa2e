"""Types of CSV columns from one pass."""

import pytest

from strandline.sources import zones
from strandline.sources.infer import inferred_schema
from strandline.sources.zones import csv_read, register_zone
from tests.conftest import plan

VALUES = {
    "int": ["1", "-7", "+3", None, ""],
    "bigint": ["1", "3000000000"],
    "double": ["1", "2.5", "-1e9", ".5", "NaN", None],
    "date": ["2031-05-02", "2031-5-2"],
    "timestamp": ["2031-05-02 08:30:00", "2031-05-02", "2031-05-02T08:30:00"],
    "boolean": ["true", "False", None],
    "string": ["1", "x"],
}
TEXT = [["1", "true"], ["2031-05-02", "5"], ["never", "2031-05-02"], [None, None], [""], ["99999999999999999999x"], ["2031-13-02"], ["1d"], [" 1"]]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "`a col` string").repartition(2)


@pytest.mark.parametrize("kind", VALUES)
def test_the_narrowest_type_that_holds_all(spark, kind):
    assert inferred_schema(column(spark, VALUES[kind])).fields[0].dataType.simpleString() == kind


@pytest.mark.parametrize("values", TEXT)
def test_everything_else_is_text(spark, values):
    (field,) = inferred_schema(column(spark, values)).fields
    assert (field.name, field.dataType.simpleString()) == ("a col", "string")


def test_long_numbers_are_doubles(spark):
    assert inferred_schema(column(spark, ["1", "99999999999999999999"])).fields[0].dataType.simpleString() == "double"


def test_types_are_those_of_the_reader(spark, tmp_path):
    lines = ["i,b,d,day,ts,flag,t", "1,5000000000,1.5,2031-05-02,2031-05-02 08:30:00,true,a", "2,1,2,2031-05-03,2031-05-02 08:30:01,false,", "3,,,,,,x"]
    (tmp_path / "z" / "t").mkdir(parents=True)
    (tmp_path / "z" / "t" / "1.csv").write_text("\n".join(lines) + "\n")
    reader = spark.read.options(**csv_read()).option("inferSchema", "true").csv(str(tmp_path / "z" / "t"))
    found = register_zone(spark, str(tmp_path / "z"), "csv")
    kinds = {r["column_name"]: r["data_type"] for r in found.collect()}
    assert kinds == dict(reader.dtypes)
    assert spark.table("t").count() == 3


def test_one_aggregate_over_one_scan(spark, tmp_path, monkeypatch):
    """All columns and types together, merged on the map side; two tables at the same time."""
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.csv").write_text("a,b\n1,x\n2,y\n")
    seen, infer = [], zones.infer_csv
    monkeypatch.setattr(zones, "infer_csv", lambda *a: seen.append(a[1]) or infer(*a))
    assert register_zone(spark, str(tmp_path), "csv").count() == 4
    assert sorted(p.rsplit("/", 1)[1] for p in seen) == ["one", "two"]
    df = spark.read.options(**csv_read()).schema("a string, b string").csv(str(tmp_path / "one"))
    aggregate = []
    monkeypatch.setattr(type(df), "first", lambda self: aggregate.append(self) or self.collect()[0])
    inferred_schema(df)
    ran = plan(aggregate[0]).split("Initial Plan")[0]
    assert ran.count("FileScan") == 1 and ran.count("Exchange SinglePartition") == 1 and "partial_min" in ran

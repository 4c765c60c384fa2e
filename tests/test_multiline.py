"""Multiline CSV read block by block against the same files read as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.session import settings
from strandline.sources import multiline as M
from strandline.sources.zones import CSV_READ, csv_read, read_bronze, scan_csv, write_csv
from strandline.schemas import TEXT, WHOLE, Table
from tests.conftest import rows

SCHEMA = "id int, text string, note string, amount double"
HEADER = "id,text,note,amount"
PIECES = ["a", 'say ""hi""', "line\nbreak", "\n", "\n\n", ",", "\\", '""', "wörter 日本", "x" * 40, "tail\n", "\r\n", ",\n,", " "]


def quoted(text):
    return f'"{text}"'


def written(draw, n, end="\n"):
    lines = [HEADER]
    for i in range(n):
        text = "".join(draw.choices(PIECES, k=draw.randint(0, 6)))
        note = draw.choice(["", '""', "plain", quoted("two\nlines"), quoted('q""q')])
        lines.append(f"{i},{quoted(text)},{note},{draw.choice(['', '1.5', 'bad'])}")
    return end.join(lines) + end


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content.encode())
    return str(folder)


def read(spark, path, size):
    """In blocks of ``size`` bytes."""
    schema = spark.createDataFrame([], SCHEMA).schema
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}):
        return rows(M.scan_split_csv(spark, path, schema, csv_read()))


def as_a_whole(spark, path):
    return rows(spark.read.options(**csv_read(True)).schema(SCHEMA).csv(path))


@pytest.mark.parametrize("size", [7, 64, 500, 10**6])
def test_blocks_of_any_size_give_the_same_rows(spark, tmp_path, size):
    """Blocks shorter than a record, borders inside quotes, doubled quotes, line breaks and characters."""
    draw = random.Random(size)
    n = 12 if size < 10 else 150
    put(tmp_path / "in" / "below", "1.csv", written(draw, n))
    put(tmp_path / "in", "2.csv", written(draw, n)[:-1])  # no line break at the end
    put(tmp_path / "in", "3.csv", HEADER + "\n")
    put(tmp_path / "in", "4.csv", HEADER + "\n\n1,a,b,2.5\n\n2,c,d,3.5\n\n")
    path = str(tmp_path / "in")
    got = read(spark, path, size)
    assert got == as_a_whole(spark, path) and len(got) == 2 * n + 2


def test_a_record_over_many_blocks(spark, tmp_path):
    long = "\n".join(f'row ""{i}""' for i in range(400))
    path = put(tmp_path / "in", "1.csv", f'{HEADER}\n1,"{long}",x,1\n2,"a",y,2\n3,"{long}",z,3\n')
    assert read(spark, path, 200) == as_a_whole(spark, path)


def test_records_that_end_with_two_characters(spark, tmp_path):
    """Line breaks in texts stay as they are."""
    path = put(tmp_path / "in", "1.csv", f'{HEADER}\r\n1,"a\r\nb",x,1\r\n2,"c\nd",y,2\r\n')
    assert read(spark, path, 9) == [(1, "a\r\nb", "x", 1.0), (2, "c\nd", "y", 2.0)]


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = put(tmp_path / "in", "1.csv", written(random.Random(1), 2000))
    schema = spark.createDataFrame([], SCHEMA).schema
    assert spark.read.options(**csv_read(True)).schema(SCHEMA).csv(path).rdd.getNumPartitions() == 1
    conf = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "0"}
    with settings(spark, conf):
        df = M.scan_split_csv(spark, path, schema, csv_read())
        tasks = df.groupBy(F.spark_partition_id().alias("task")).count()
        assert tasks.where("count > 50").count() > 5
        assert rows(df) == as_a_whole(spark, path)
    # the same frame in splits of another size
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "5k"}), pytest.raises(Exception, match="have changed"):
        df.sparkSession.catalog.clearCache()
        df.select("*").where("id >= 0").collect()


@pytest.mark.parametrize("header", ["id,text,note", "id,text,note,amount,more", "id,note,text,amount"])
def test_another_header_fails(spark, tmp_path, header):
    path = put(tmp_path / "in", "1.csv", f"{header}\n1,a,b,2\n")
    with pytest.raises(Exception, match="header is not that"):
        read(spark, path, 50)


def test_an_open_quote_fails(spark, tmp_path):
    path = put(tmp_path / "in", "1.csv", f'{HEADER}\n1,"a,b,2\n')
    with pytest.raises(Exception, match="not closed"):
        read(spark, path, 50)


def test_bronze_tables_with_large_files_are_split(spark, tmp_path):
    table = Table("texts", {"id": WHOLE, "text": TEXT, "note": TEXT}, multiline=True)
    made = [(str(i), f'line {i}\n"quoted", {i}' * (i % 5), None if i % 3 else "") for i in range(500)]
    df = spark.createDataFrame(made, table.bronze_schema)
    write_csv(df.coalesce(1), str(tmp_path / "texts"), multiline=True)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}):
        got = read_bronze(spark, str(tmp_path), table)
        assert got.rdd.getNumPartitions() > 3
        assert rows(got) == rows(df)
    whole = scan_csv(spark, str(tmp_path / "texts"), table.bronze_schema, multiline=True)
    assert whole.rdd.getNumPartitions() == 1 and rows(whole) == rows(df)
    assert set(M.PARSER) <= set(CSV_READ)

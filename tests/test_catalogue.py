"""Every registered query, and its SQL twin where it has one, on the given tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import differences

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="no given tables")


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, twin, name):
    got = queries()[name](spark, str(FOLDER)).toPandas()
    assert differences(got, twin.execute(oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_twin_gives_rows(spark, name):
    assert queries()[name](spark, str(FOLDER)).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 5

import threading

import pytest
from pyspark.sql import DataFrame

from strandline.operators.clean import clean
from strandline.plans.catalogue import tables as T
from strandline.schemas import VITALS
from strandline.sources.zones import read_bronze, scan_csv
from strandline.streaming import readings as R
from tests.conftest import rows

HEADER = ",".join(VITALS.columns)
FILES = {
    "1.csv": [
        "M1,Q1,Burns,2031-05-02 08:30:00,64,98.1,36.5,118,77",
        "M1,Q1,Burns,2031-05-02 08:30:00,64.0,98.1,36.5,118,77",
        "M2,Q2,Burns,never,88,97.0,37.9,131,85",
        "M9,,Burns,2031-05-02 08:30:00,64,98.1,36.5,118,77",
    ],
    "2.csv": ["M1,Q1,Burns,2031-07-11 23:00:00,66,98.1,36.5,118,77"],
    # copies of rows seen long before, and a late new row
    "3.csv": [
        "M1,Q1,Burns,2031-05-02 08:30:00,64.00,98.1,36.5,118,77",
        "M2,Q2,Burns,never,88.0,97.0,37.9,131,85",
        "M1,Q1,Burns,2031-05-02 04:15:00,61,98.1,36.5,118,77",
    ],
}


@pytest.fixture()
def folders(tmp_path):
    arrived = tmp_path / "arrived"
    arrived.mkdir()
    return arrived, tmp_path


def put(folder, *names):
    for name in names:
        (folder / name).write_text("\n".join([HEADER, *FILES[name]]) + "\n")


def run(spark, base):
    bronze = str(base / "bronze")
    arrived = R.arriving(spark, str(base / "arrived"), VITALS, files_per_batch=1)
    R.ingest(arrived, bronze, str(base / "c1")).awaitTermination()
    stream = R.arriving(spark, bronze, VITALS, files_per_batch=1)
    silver = str(base / "silver")
    R.silver_exact(stream, VITALS, silver, str(base / "c2")).awaitTermination()
    return rows(R.read_silver_stream(spark, VITALS, silver))


def test_stream_equals_batch_with_late_copies(spark, folders):
    arrived, base = folders
    put(arrived, "1.csv")
    assert len(run(spark, base)) == 2
    put(arrived, "2.csv", "3.csv")
    got = run(spark, base)
    batch = clean(scan_csv(spark, str(arrived), VITALS.bronze_schema), VITALS)
    assert got == rows(batch) and len(got) == 4
    # nothing new: nothing changes, in Bronze either
    assert run(spark, base) == got
    bronze = scan_csv(spark, str(base / "bronze"), VITALS.bronze_schema)
    assert rows(bronze) == rows(scan_csv(spark, str(arrived), VITALS.bronze_schema))


def test_the_batch_job_sees_streamed_and_bulk_rows(spark, folders):
    arrived, base = folders
    bulk = base / "bronze" / "vitals"
    bulk.mkdir(parents=True)
    put(bulk, "1.csv")
    put(arrived, "2.csv")
    stream = R.arriving(spark, str(arrived), VITALS)
    R.ingest(stream, str(bulk), str(base / "c1")).awaitTermination()
    assert read_bronze(spark, str(base / "bronze"), VITALS).count() == 5


def test_a_batch_that_runs_again_changes_nothing(spark, folders):
    """The state of the last batch is lost after its rows were written."""
    arrived, base = folders
    put(arrived, "1.csv", "2.csv", "3.csv")
    got = run(spark, base)
    for checkpoint in ("c1", "c2"):
        commits = base / checkpoint / "commits"
        last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
        last.unlink()
        (commits / f".{last.name}.crc").unlink(missing_ok=True)
    assert run(spark, base) == got
    bronze = scan_csv(spark, str(base / "bronze"), VITALS.bronze_schema)
    assert bronze.count() == sum(map(len, FILES.values()))


def test_two_sources_feed_one_table(spark, folders):
    """Each with a checkpoint of its own, so that both number their batches from 0."""
    arrived, base = folders
    other = base / "other"
    other.mkdir()
    put(arrived, "1.csv")
    put(other, "2.csv", "3.csv")
    bronze, silver = str(base / "bronze"), str(base / "silver")
    for i, source in enumerate((arrived, other)):
        R.ingest(R.arriving(spark, str(source), VITALS), bronze, str(base / f"in{i}")).awaitTermination()
        stream = R.arriving(spark, str(source), VITALS)
        R.silver_exact(stream, VITALS, silver, str(base / f"out{i}")).awaitTermination()
    stored = scan_csv(spark, bronze, VITALS.bronze_schema)
    assert stored.count() == sum(map(len, FILES.values()))
    assert rows(R.read_silver_stream(spark, VITALS, silver)) == rows(clean(stored, VITALS))


def test_a_lost_checkpoint_doubles_no_silver_row(spark, folders):
    arrived, base = folders
    put(arrived, *FILES)
    silver = str(base / "silver")
    for name in ("first", "fresh"):
        stream = R.arriving(spark, str(arrived), VITALS, files_per_batch=1)
        R.silver_exact(stream, VITALS, silver, str(base / name)).awaitTermination()
    batch = clean(scan_csv(spark, str(arrived), VITALS.bronze_schema), VITALS)
    assert rows(R.read_silver_stream(spark, VITALS, silver)) == rows(batch)


def test_rows_without_a_time_are_dealt_over_partitions(spark, folders):
    arrived, base = folders
    lines = [f"M{i},Q{i},Burns,never,88,97.0,37.9,131,85" for i in range(300)]
    (arrived / "x.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    assert len(run(spark, base)) == 300
    assert len(list((base / "silver").glob("stream_day=none-*"))) > 40


def test_merged_days_hold_the_same_rows(spark, folders, monkeypatch):
    arrived, base = folders
    put(arrived, "1.csv", "2.csv", "3.csv")
    got, silver = run(spark, base), str(base / "silver")
    moved = []

    def once(*paths):
        if moved:
            raise OSError("lost")
        moved.append(paths)
        move(*paths)

    (arrived / "4.csv").write_text(
        "\n".join([HEADER, "M3,Q3,Burns,2031-05-02 09:00:00,70,97.0,37.9,131,85", "M3,Q3,Burns,2031-07-11 09:00:00,70,97.0,37.9,131,85"]) + "\n"
    )
    got, move = run(spark, base), R.move_path
    monkeypatch.setattr(R, "move_path", once)
    with pytest.raises(OSError):
        R.compact_silver(spark, VITALS, silver)
    monkeypatch.setattr(R, "move_path", move)
    assert R.compact_silver(spark, VITALS, silver) == 2
    assert rows(R.read_silver_stream(spark, VITALS, silver)) == got
    assert R.compact_silver(spark, VITALS, silver) == 0
    assert [len(list(d.iterdir())) for d in (base / "silver").glob("stream_day=2031-05-02")] == [1]
    assert run(spark, base) == got


def test_a_batch_is_stored_nowhere_but_in_silver(spark, folders, monkeypatch):
    """Caching a batch's text costs more than parsing its files once more."""
    arrived, base = folders

    def stored(*_):
        raise AssertionError("a batch was cached")

    for kind in {DataFrame, type(spark.range(1))}:
        for name in ("persist", "cache"):
            monkeypatch.setattr(kind, name, stored)
    put(arrived, *FILES)
    assert len(run(spark, base)) == 4


def test_three_tables_arrive_at_the_same_time(spark, tmp_path, monkeypatch):
    """No stream of gold_incremental waits for another to end."""
    tables = {
        "orders": "SELECT 2L AS o_orderkey, 9e4D AS o_totalprice, 'low' AS o_orderpriority, 'F' AS o_orderstatus, "
        "TIMESTAMP_NTZ '2031-02-09 00:00:00' AS o_orderdate",
        "lineitem": "SELECT 5L AS l_suppkey, 2L AS l_orderkey, 'O' AS l_linestatus, 64D AS l_quantity, 0.1D AS l_discount, "
        "0.2D AS l_tax, 1 AS l_linenumber, TIMESTAMP_NTZ '2031-05-02 00:00:00' AS l_shipdate",
        "events": "SELECT TIMESTAMP_NTZ '2031-05-02 08:30:00' AS ts, 'view' AS event_type, 2D AS value, 7L AS user_id",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    started, begin = threading.Barrier(3, timeout=60), T.silver_exact

    def together(*args):
        started.wait()
        return begin(*args)

    monkeypatch.setattr(T, "silver_exact", together)
    out = T.gold_incremental(spark, str(tmp_path)).collect()
    got = {(r["gold_table"], r["key_1"]): (r["metric_1"], r["metric_3"]) for r in out}
    assert got == {
        ("department_kpis", "view"): (200.0, 7),
        ("readmission_by_age", "low"): (100.0, 1),
        ("vitals_by_admission_type", "F"): (64.0, 1),
        ("daily_trend", "2031-05-02"): (200.0, 7),
        ("refreshed", "patients"): (None, 0),
        ("refreshed", "vitals"): (None, 0),
        ("refreshed", "operations"): (None, 0),
    }


def test_bounded_stream_removes_near_copies(spark, folders):
    arrived, base = folders
    put(arrived, "1.csv", "2.csv")
    stream = R.arriving(spark, str(arrived), VITALS)
    query = (
        R.silver_bounded(stream, VITALS, "1 day")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(base / "c3"))
        .trigger(availableNow=True)
        .start(str(base / "bounded"))
    )
    query.awaitTermination()
    stored = spark.read.schema(VITALS.silver_schema).parquet(str(base / "bounded"))
    assert rows(stored) == rows(clean(scan_csv(spark, str(arrived), VITALS.bronze_schema), VITALS))


def test_bounded_stream_goes_on_from_its_checkpoint(spark, folders):
    """State lies in RocksDB; a copy of a row of the first run and a row behind the watermark are dropped by the second."""
    arrived, base = folders
    silver, state = str(base / "bounded"), str(base / "state")

    def append(number, *lines):
        (arrived / f"{number}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        stream = R.arriving(spark, str(arrived), VITALS)
        R.append_bounded(stream, VITALS, silver, state, "1 day").awaitTermination()
        return sorted(r["heart_rate"] for r in spark.read.schema(VITALS.silver_schema).parquet(silver).collect())

    row = "M1,Q1,Burns,2031-05-{} 08:30:00,{},98.1,36.5,118,77".format
    assert append(1, row("02", 1), row("02", "1.0"), row("04", 2)) == [1, 2]
    # the watermark is the 3rd, 08:30
    assert append(2, row("04", "2.0"), row("03", 3), "M1,Q1,Burns,2031-05-03 08:30:01,4,98.1,36.5,118,77") == [1, 2, 4]
    assert append(3, row("03", 5), row("09", 6)) == [1, 2, 4, 6]
    stores = {p.suffix for p in (base / "state" / "state").rglob("*") if p.is_file()}
    assert stores & {".zip", ".changelog"} and ".delta" not in stores
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" not in spark.conf.get(provider)  # the session is as before

"""Batches of which a reader sees all tables or none."""

import threading

import pytest

from strandline.plans import hospital
from strandline.schemas import HOSPITAL
from strandline.sources.runs import MARKERS, RUNS, current_path, current_tables, whole_run
from strandline.sources.zones import read_curated, register_zone, table_path, write_parquet
from tests.conftest import rows
from tests.test_hospital import ROWS

GOLD = ("department_kpis", "readmission_by_age", "daily_trend")


def put_bronze(base, extra=""):
    for name, lines in ROWS.items():
        folder = base / "bronze" / name
        folder.mkdir(parents=True, exist_ok=True)
        more = [line.replace("General", extra) for line in lines] if extra else []
        (folder / "part.csv").write_text("\n".join([",".join(HOSPITAL[name].columns), *lines, *more]) + "\n")


def run(spark, base):
    hospital.medallion_run(spark, *[str(base / zone) for zone in ("bronze", "silver", "gold")])


def seen(spark, base):
    silver = [rows(read_curated(spark, str(base / "silver"), t)) for t in HOSPITAL.values()]
    return silver + [rows(read_curated(spark, str(base / "gold"), t)) for t in GOLD]


@pytest.mark.parametrize("broken", [*HOSPITAL, *GOLD])
def test_a_run_that_fails_changes_no_table(spark, tmp_path, monkeypatch, broken):
    put_bronze(tmp_path)
    run(spark, tmp_path)
    before = seen(spark, tmp_path)
    put_bronze(tmp_path, extra="Eyes")

    def write(df, path, *rest):
        if path.endswith(f"/{broken}"):
            raise OSError("disk full")
        write_parquet(df, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(hospital, "write_parquet", write)
        with pytest.raises(OSError):
            run(spark, tmp_path)
    assert seen(spark, tmp_path) == before
    for zone in ("silver", "gold"):  # nothing of it is left
        assert len(list((tmp_path / zone / RUNS).iterdir())) == len(list((tmp_path / zone / MARKERS).glob("0*")))
    run(spark, tmp_path)
    after = seen(spark, tmp_path)
    assert all(len(a) >= len(b) for a, b in zip(after, before)) and after[3] != before[3]


def test_versions_are_kept_for_running_readers(spark, tmp_path):
    zone, df = str(tmp_path), spark.range(3)
    read = []
    for i in range(4):
        with whole_run(spark, zone) as (own,):
            write_parquet(df.selectExpr(f"id + {i} AS id"), table_path(own, "a"))
            if i == 0:  # a table that later runs do not write
                write_parquet(df, table_path(own, "b"))
        read.append(spark.read.parquet(current_path(spark, zone, "a")))
    assert rows(read[3]) == [(3,), (4,), (5,)] and rows(read[2]) == [(2,), (3,), (4,)]
    assert current_tables(spark, zone) == {t: current_path(spark, zone, t) for t in ("a", "b")}
    assert rows(spark.read.parquet(current_path(spark, zone, "b"))) == [(0,), (1,), (2,)]
    assert len(list((tmp_path / RUNS).iterdir())) == 3  # two versions of a, one of b


def test_runs_that_end_at_the_same_time(spark, tmp_path):
    zone, both, failed = str(tmp_path), threading.Barrier(4), []

    def one(i):
        try:
            with whole_run(spark, zone, kept=9) as (own,):
                write_parquet(spark.range(i), table_path(own, "a"))
                both.wait(60)
        except BaseException as error:
            failed.append(error)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert len([p for p in (tmp_path / MARKERS).iterdir() if p.name[0] == "0"]) == 4
    assert spark.read.parquet(current_path(spark, zone, "a")).count() in range(4)


def test_a_zone_without_runs_is_read_as_it_is(spark, tmp_path):
    write_parquet(spark.range(2), table_path(str(tmp_path), "a"))
    assert current_path(spark, str(tmp_path), "a") == table_path(str(tmp_path), "a")
    assert read_curated(spark, str(tmp_path), "a").count() == 2
    with whole_run(spark, str(tmp_path)) as (own,):
        write_parquet(spark.range(5), table_path(own, "a"))
    assert read_curated(spark, str(tmp_path), "a").count() == 5


def test_registered_tables_move_to_the_last_run(spark, tmp_path):
    zone = str(tmp_path / "zone")
    try:
        for i in (1, 2):
            with whole_run(spark, zone) as (own,):
                write_parquet(spark.range(i), table_path(own, "plain_rows"))
                write_parquet(spark.range(i).selectExpr("id", "id % 2 AS part"), table_path(own, "parted_rows"), ["part"])
            found = register_zone(spark, zone, "parquet", database="runs_test")
            assert sorted({r["table_name"] for r in found.collect()}) == ["parted_rows", "plain_rows"]
            for table in ("plain_rows", "parted_rows"):
                assert spark.table(f"runs_test.{table}").count() == i
    finally:
        spark.sql("DROP DATABASE IF EXISTS runs_test CASCADE")

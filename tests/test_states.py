"""Partial states and the Gold tables that are merged from them."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from strandline.operators import states as S
from strandline.plans import hospital as H
from strandline.schemas import HOSPITAL, OPERATIONS, VITALS
from strandline.sources.zones import read_curated
from strandline.streaming import gold as G
from strandline.streaming import readings as R
from tests.conftest import rows

METRICS = {
    "n": S.count,
    "all": lambda: S.total("v"),
    "top": lambda: S.highest("v"),
    "bottom": lambda: S.lowest("v"),
    "avg": lambda: S.mean("v"),
    "scaled": lambda: S.mean("v", 1, 100),
    "ones": lambda: S.share("flag"),
    "kinds": lambda: S.distinct("v"),
}


def test_merged_states_equal_the_metrics_over_all_rows(spark):
    draw = random.Random(1)
    made = [(draw.choice("abc"), draw.randint(0, 3), draw.choice([None, *range(9)]), draw.choice([None, 0, 1])) for _ in range(400)]
    made += [("only nulls", 1, None, None)]
    df = spark.createDataFrame(made, "k string, day int, v int, flag int")
    metrics = {name: m() for name, m in METRICS.items()}
    stored = S.partial_states(df, ["k", "day"], metrics)
    got = S.from_states(stored, ["k"], metrics)
    direct = df.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("all"), F.max("v").alias("top"), F.min("v").alias("bottom"),
        F.avg("v").alias("avg"), F.round(F.avg("v") * 100, 1).alias("scaled"),
        F.round(F.avg("flag") * 100, 1).alias("ones"), F.countDistinct("v").alias("kinds"),
    )
    assert rows(got) == rows(direct) and got.columns == direct.columns
    # merged in two steps
    coarser = S.merged_states(stored.where("day < 2"), ["k"], metrics).unionByName(
        S.merged_states(stored.where("day >= 2"), ["k"], metrics)
    )
    assert rows(S.from_states(coarser, ["k"], metrics)) == rows(direct)
    whole = S.from_states(stored, [], metrics).first()
    assert whole["n"] == 401 and whole["kinds"] == 9
    empty = S.from_states(stored.where("day > 9"), [], metrics).first()
    assert empty["all"] is None and empty["avg"] is None and empty["kinds"] == 0


# --- Gold that follows the streams ---

HEADERS = {name: ",".join(t.columns) for name, t in HOSPITAL.items()}
FIRST = {
    "patients": [
        "Q1,30,F,Burns,Planned,x,2031-05-02 08:00:00,2031-05-09 08:00:00,7,1",
        "Q2,70,M,Burns,Emergency,x,2031-05-02 09:00:00,2031-05-03 08:00:00,1,0",
        "Q3,,M,Eyes,Emergency,x,never,never,1,",
    ],
    "vitals": [
        "M1,Q1,Burns,2031-05-02 08:30:00,64,98.1,36.5,118,77",
        "M1,Q2,Burns,2031-05-02 08:31:00,90,97.1,36.9,128,77",
        "M2,Q3,Eyes,never,70,98.1,36.5,118,77",
        "M2,Q9,Eyes,2031-05-02 08:30:00,70,98.1,36.5,118,77",
    ],
    "operations": [
        "2031-05-02 08:00:00,Burns,10,7,0.7,4,20",
        "2031-05-03 08:00:00,Burns,10,9,0.9,2,40",
        "never,Eyes,10,1,0.1,2,",
    ],
}
SECOND = {  # a copy, a late row, a new day
    "patients": [FIRST["patients"][0], "Q4,17,M,Eyes,Planned,x,2031-05-02 07:00:00,2031-05-09 08:00:00,7,0"],
    "vitals": [
        "M1,Q1,Burns,2031-05-02 08:30:00,64.0,98.10,36.5,118,77",
        "M1,Q4,Eyes,2031-05-02 01:00:00,101,95.1,37.5,140,90",
        "M1,Q1,Burns,2031-05-08 08:30:00,66,98.1,36.5,118,77",
    ],
    "operations": ["2031-05-02 08:00:00,Burns,10,7,0.70,4,20", "2031-05-02 09:00:00,Eyes,10,8,0.8,9,10"],
}


def arrive(base, name, number, lines):
    folder = base / "arrived" / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{number}.csv").write_text("\n".join([HEADERS[name], *lines]) + "\n")


def stream(spark, base, name, source=None, checkpoint="state"):
    arriving = R.arriving(spark, str(source or base / "arrived" / name), HOSPITAL[name])
    return R.silver_exact(arriving, HOSPITAL[name], str(base / "silver" / name), str(base / checkpoint / name))


def refresh(spark, base):
    return H.refresh_gold(spark, *[str(base / zone) for zone in ("silver", "states", "gold")])


def rebuilt(spark, base):
    """The four tables from all of Silver."""
    silver = {n: R.read_silver_stream(spark, t, str(base / "silver" / n)) for n, t in HOSPITAL.items()}
    return {
        "department_kpis": H.department_kpis(silver["operations"], ordered=False),
        "readmission_by_age": H.readmission_by_age(silver["patients"], ordered=False),
        "vitals_by_admission_type": H.vitals_by_admission_type(silver["vitals"], silver["patients"]),
        "daily_trend": H.load_trend(silver["operations"], "snapshot_date", "snapshot_date"),
    }


def assert_gold(spark, base):
    for name, want in rebuilt(spark, base).items():
        got = read_curated(spark, str(base / "gold"), name)
        assert got.columns == want.columns, name
        assert rows(got) == rows(want), name


@pytest.fixture()
def base(tmp_path):
    return tmp_path


def test_gold_follows_late_rows_and_reads_touched_days_only(spark, base):
    for name, lines in FIRST.items():
        arrive(base, name, 1, lines)
        stream(spark, base, name).awaitTermination()
    # patients and vitals: a day and the rows without a time; operations: two days and those
    assert refresh(spark, base) == {"patients": 2, "vitals": 2, "operations": 3}
    assert_gold(spark, base)
    assert refresh(spark, base) == {"patients": 0, "vitals": 0, "operations": 0}
    before = {p: p.stat().st_mtime_ns for p in (base / "states").rglob("*.parquet")}
    for name, lines in SECOND.items():
        arrive(base, name, 2, lines)
        stream(spark, base, name).awaitTermination()
    assert refresh(spark, base) == {"patients": 1, "vitals": 2, "operations": 1}
    assert_gold(spark, base)
    after = {p: p.stat().st_mtime_ns for p in (base / "states").rglob("*.parquet")}
    untouched = [p for p in before if "2031-05-02" not in str(p)]
    assert untouched and all(after[p] == before[p] for p in untouched)
    # merged files hold the same rows
    assert R.compact_silver(spark, OPERATIONS, str(base / "silver" / "operations")) == 1
    refresh(spark, base)
    assert_gold(spark, base)


def test_a_refresh_that_was_interrupted_is_made_up_for(spark, base, monkeypatch):
    for name, lines in FIRST.items():
        arrive(base, name, 1, lines)
        stream(spark, base, name).awaitTermination()
    refresh(spark, base)
    for name, lines in SECOND.items():
        arrive(base, name, 2, lines)
        stream(spark, base, name).awaitTermination()

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(G, "partial_states", broken)
        with pytest.raises(OSError):
            refresh(spark, base)
    assert refresh(spark, base) == {"patients": 1, "vitals": 2, "operations": 1}
    assert_gold(spark, base)


def test_streams_at_the_same_time_feed_silver_and_gold(spark, base, monkeypatch):
    """Both batches have looked for stored rows before either of them writes."""
    both, look = threading.Barrier(2, timeout=120), R.path_exists

    def together(*args):
        found = look(*args)
        both.wait()
        return found

    other = base / "other"
    other.mkdir()
    arrive(base, "vitals", 1, FIRST["vitals"])
    (other / "1.csv").write_text("\n".join([HEADERS["vitals"], *FIRST["vitals"][:2], *SECOND["vitals"]]) + "\n")
    for name in ("patients", "operations"):
        arrive(base, name, 1, FIRST[name])
        stream(spark, base, name).awaitTermination()
    with monkeypatch.context() as patch:
        patch.setattr(R, "path_exists", together)
        running = [stream(spark, base, "vitals"), stream(spark, base, "vitals", other, "state-2")]
        for query in running:
            query.awaitTermination()
    stored = spark.read.parquet(str(base / "silver" / "vitals"))
    silver = str(base / "silver" / "vitals")
    distinct = {line.replace("64.0", "64").replace("98.10", "98.1") for line in FIRST["vitals"] + SECOND["vitals"]}
    assert stored.count() > len(distinct)  # copies were written
    assert stored.select(R.QUERY).distinct().count() == 2
    assert R.read_silver_stream(spark, VITALS, silver).count() == len(distinct)
    refresh(spark, base)
    assert_gold(spark, base)
    assert R.compact_silver(spark, VITALS, silver) >= 1
    assert R.read_silver_stream(spark, VITALS, silver).count() == len(distinct)
    assert spark.read.parquet(silver).count() == len(distinct)
    refresh(spark, base)
    assert_gold(spark, base)


def test_parents_that_occur_twice_count_twice(spark):
    children = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, None), (None, 1, 9.0)], "k string, day int, v double")
    parents = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", "y"), (None, "y")], "k string, kind string")
    metrics = {"avg": S.mean("v", 1), "all": S.total("v"), "n": S.count()}
    stored = S.partial_states(children, ["day", "k"], metrics)
    got = G.kpi_of_parents(stored, parents, "k", "kind", metrics)
    assert rows(got) == [("x", 1, 3.0, 12.0, 4), ("y", 1, None, None, 1)]


def test_hashes_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("a", "")], "patient_id string, device_id string")
    wide = df.withColumns({c: F.lit(None).cast("string") for c in VITALS.silver_schema.names if c not in df.columns})
    hashed = R._with_hashes(wide, VITALS)
    assert hashed.select(*R.HASHES).distinct().count() == 4
    assert hashed.where(f"{R.HASHES[0]} = {R.HASHES[1]}").count() == 0


def test_listing_reads_no_file(spark, base):
    arrive(base, "patients", 1, FIRST["patients"])
    stream(spark, base, "patients").awaitTermination()
    silver = base / "silver" / "patients"
    want = {p.name for p in silver.rglob("*.parquet")}
    for p in silver.rglob("*.parquet"):
        p.write_bytes(b"no parquet")
    found = R.silver_files(spark, str(silver)).collect()
    assert {r["path"].rsplit("/", 1)[1] for r in found} == want
    assert {r[R.DAY] for r in found} == {p.name.split("=")[1] for p in silver.iterdir() if "=" in p.name}

"""The batch and the dashboard queries, on hand-made rows and on a season of own rows."""

import csv
import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from strandline.operators.clean import clean
from strandline.plans import hospital
from strandline.schemas import HOSPITAL, PATIENTS, VITALS
from strandline.sources.zones import read_bronze, read_curated
from tests.conftest import rows

ROWS = {
    "patients": [
        "P1,70,F,General,Planned,Asthma,2025-01-01 10:00:00,2025-01-03 10:00:00,2,1",
        "P1,70.0,F,General,Planned,Asthma,2025-01-01 10:00:00,2025-01-03 10:00:00,2,1",
        "P2,abc,M,General,Emergency,Asthma,2025-01-01 10:00:00,soon,2,0",
        ",30,M,General,Planned,Asthma,2025-01-01 10:00:00,2025-01-03 10:00:00,2,0",
        "P3,17,M,General,Planned,Asthma,2025-01-01 10:00:00,2025-01-03 10:00:00,2,",
    ],
    "vitals": [
        "D1,P1,General,2025-01-01 11:00:00,72,97.0,36.8,120,80",
        "D1,P1,General,2025-01-01 11:00:00,72.0,97.0,36.8,120,80",
        "D1,P1,General,2025-01-01 12:00:00,78.0,97.0,36.8,121,80",
        "D1,P2,General,2025-01-01 12:00:00,105,x,37.6,140,90",
        "D1,P9,General,2025-01-01 12:00:00,300,93.0,37.6,140,90",
    ],
    "operations": [
        "2025-01-01 05:00:00,General,50,25,0.5,3,20",
        "2025-01-01 06:00:00,General,50,25,0.6,9,21",
        "2025-01-02 06:00:00,Oncology,20,18,0.9,1,5",
        "bad,,20,18,0.9,1,5",
    ],
}


@pytest.fixture()
def bronze(tmp_path):
    for name, lines in ROWS.items():
        folder = tmp_path / "bronze" / name
        folder.mkdir(parents=True)
        header = ",".join(HOSPITAL[name].columns)
        (folder / "part.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(tmp_path / "bronze")


def test_batch_twice_gives_the_same_tables(spark, bronze, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    seen = []
    for _ in range(2):
        hospital.medallion_run(spark, bronze, silver, gold)
        seen.append(
            [rows(read_curated(spark, silver, t)) for t in HOSPITAL.values()]
            + [
                rows(read_curated(spark, gold, t))
                for t in ("department_kpis", "readmission_by_age", "daily_trend")
            ]
        )
    assert seen[0] == seen[1]
    patients, vitals, operations, kpis, ages, days = seen[0]
    assert (len(patients), len(vitals), len(operations)) == (3, 4, 4)
    assert kpis == [("General", 55.0, 20.5, 9), ("Oncology", 90.0, 5.0, 1), (None, 90.0, 5.0, 1)]
    assert ages == [("General", "0-17", 1, None, None), ("General", "65+", 2, 1, 50.0)]
    assert sorted((str(d), *rest) for d, *rest in days) == [
        ("2025-01-01", 55.0, 20.5, 12),
        ("2025-01-02", 90.0, 5.0, 1),
        ("None", 90.0, 5.0, 1),
    ]


def test_vitals_by_admission_type(spark, bronze):
    vitals = clean(read_bronze(spark, bronze, VITALS), VITALS)
    patients = clean(read_bronze(spark, bronze, PATIENTS), PATIENTS)
    got = [tuple(r) for r in hospital.vitals_by_admission_type(vitals, patients).collect()]
    # 120.5 rounds half up; P9 is unknown and P3 has no readings
    assert got == [("Emergency", 1, 105.0, None, 37.6, 140.0), ("Planned", 1, 75.0, 97.0, 36.8, 121.0)]


# --- a season of own rows, written by another CSV writer and counted in plain Python ---

WARDS = ["Burns", "Day clinic", "Ward, north", 'The "old" ward']


@pytest.fixture(scope="module")
def season(spark, tmp_path_factory):
    draw = random.Random(21)
    start = datetime(2031, 5, 1)
    patients, vitals, operations = [], [], []
    for i in range(180):
        stay, came = draw.randint(1, 9), start + timedelta(hours=draw.randint(0, 900))
        patients.append(
            (f"Q{i}", draw.choice([draw.randint(0, 96), 17, 18, 40, 65, 66]), draw.choice("FM"), draw.choice(WARDS),
             draw.choice(["Acute", "Listed"]), "None known", came, came + timedelta(days=stay), stay, int(draw.random() < 0.3))
        )
        for k in range(draw.randint(0, 4)):
            vitals.append(
                (f"M{k}", f"Q{i}", WARDS[0], came + timedelta(hours=k), draw.randint(600, 1300) / 10,
                 draw.randint(900, 1000) / 10, draw.randint(360, 390) / 10, draw.randint(90, 160), 70)
            )
    for hour in range(24 * 5):
        for ward in WARDS:
            beds = draw.randint(20, 40)
            used = draw.randint(5, beds)
            operations.append(
                (start + timedelta(hours=hour), ward, beds, used, round(used / beds, 3), draw.randint(0, 12), draw.randint(0, 90))
            )
    made = {"patients": patients, "vitals": vitals, "operations": operations}
    zone = tmp_path_factory.mktemp("season")
    for name, data in made.items():
        (zone / name).mkdir()
        with (zone / name / "all.csv").open("w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(HOSPITAL[name].columns)
            writer.writerows(data + data[:20])  # some rows come twice
    return made, {t.name: clean(read_bronze(spark, str(zone), t), t).cache() for t in HOSPITAL.values()}


def mean(values, digits, scale=1):
    """Scaled first, then rounded half up."""
    whole = Decimal(repr(sum(values) / len(values) * scale))
    return float(whole.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_season_department_kpis(season):
    made, tables = season
    want = []
    for ward in WARDS:
        own = [r for r in made["operations"] if r[1] == ward]
        want.append((ward, mean([r[4] for r in own], 1, 100), mean([r[6] for r in own], 1), max(r[5] for r in own)))
    got = [tuple(r) for r in hospital.department_kpis(tables["operations"]).collect()]
    assert got == sorted(want, key=lambda r: (-r[1], r[0]))


def test_season_readmission(season):
    made, tables = season

    def group(age):
        return "0-17" if age < 18 else "18-40" if age <= 40 else "41-65" if age <= 65 else "65+"

    cells = {}
    for r in made["patients"]:
        for key in ((r[3], group(r[1])), (group(r[1]),)):
            cells.setdefault(key, []).append(r[9])
    want = {k: (len(v), sum(v), mean(v, 1, 100)) for k, v in cells.items()}
    both = hospital.readmission_by_age(tables["patients"]).collect()
    alone = hospital.readmission_by_age(tables["patients"], by_department=False).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in both} | {tuple(r)[:1]: tuple(r)[1:] for r in alone} == want


def test_season_vitals(season):
    made, tables = season
    kinds = {r[0]: r[4] for r in made["patients"]}
    want = []
    for kind in ("Acute", "Listed"):
        own = [r for r in made["vitals"] if kinds[r[1]] == kind]
        means = [mean([r[c] for r in own], d) for c, d in ((4, 1), (5, 1), (6, 2), (7, 0))]
        want.append((kind, len({r[1] for r in own}), *means))
    got = [tuple(r) for r in hospital.vitals_by_admission_type(tables["vitals"], tables["patients"]).collect()]
    assert got == sorted(want, key=lambda r: -r[2])


def test_season_trend(season):
    made, tables = season
    want = []
    for day in sorted({r[0].date() for r in made["operations"]}):
        own = [r for r in made["operations"] if r[0].date() == day]
        want.append((day, mean([r[4] for r in own], 1, 100), mean([r[6] for r in own], 1), sum(r[5] for r in own)))
    assert [tuple(r) for r in hospital.load_trend(tables["operations"]).collect()] == want


def test_season_loses_nothing(season):
    """Stays fit the dates, and readings lie within a stay."""
    made, tables = season
    assert {n: df.count() for n, df in tables.items()} == {n: len(set(r)) for n, r in made.items()}
    patients = tables["patients"]
    wrong = patients.where("discharge_ts != admission_ts + make_interval(0, 0, 0, length_of_stay)")
    outside = tables["vitals"].join(patients, "patient_id").where(
        "reading_ts < admission_ts or reading_ts >= discharge_ts"
    )
    assert wrong.count() == 0 and outside.count() == 0

"""The model job on hospital-like rows, and the sizing of large inputs."""

import numpy as np
import pytest

from strandline import session
from strandline.plans.readmission import readmission_run
from strandline.schemas import PATIENTS
from strandline.sources.zones import write_parquet


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Older patients and the emergency department return more often."""
    rng = np.random.default_rng(11)
    data = []
    for i in range(1500):
        age, stay = int(rng.integers(1, 95)), int(rng.integers(1, 15))
        department = str(rng.choice(["Emergency", "General", "Oncology"]))
        p = 0.08 + 0.35 * (age > 65) + 0.1 * (department == "Emergency")
        data.append(
            (f"P{i:05d}", None if i % 100 == 7 else age, "F" if i % 2 else "M", department, "Planned", "Asthma", None, None,
             stay, int(rng.random() < p))
        )
    zone = str(tmp_path_factory.mktemp("silver"))
    write_parquet(spark.createDataFrame(data, PATIENTS.silver_schema), f"{zone}/patients")
    return zone


def test_the_job_writes_its_tables(spark, silver, tmp_path):
    out = str(tmp_path)
    doc = readmission_run(spark, silver, out, trees=20, depth=5).first()
    patients = spark.read.parquet(f"{silver}/patients")
    positives = patients.where("readmitted_30d = 1").count()
    want = int(positives * 0.25 + 0.5) + int((1500 - positives) * 0.25 + 0.5)
    assert doc.test_size == want == spark.read.parquet(f"{out}/predictions").count()
    listed = spark.read.parquet(f"{out}/predictions")
    known = listed.where("age IS NOT NULL").count()
    assert doc.scored_size == known == listed.where("forest_score IS NOT NULL").count() < want
    assert sum(map(sum, doc.confusion_matrix_rf)) == known
    assert doc.positive_rate == round(positives / 1500, 3)
    assert doc.random_forest.roc_auc > 0.6 and doc.logistic_regression.roc_auc > 0.6
    assert doc.top_features[0].feature == "age" and len(doc.top_features) == 6
    ranked = spark.read.parquet(f"{out}/top_features")
    assert ranked.count() == 9 and ranked.where("feature = 'department_Emergency'").count() == 1
    risk = spark.read.parquet(f"{out}/high_risk")
    assert 0 < risk.count() < 1500 and risk.where("score < 0.5").count() == 0
    for name in ("roc_logistic", "roc_forest"):
        curve = spark.read.parquet(f"{out}/{name}")
        assert curve.where("fpr = 1 and tpr = 1").count() == 1


def test_settings_follow_the_input_inside_the_block_only(spark, monkeypatch):
    keys = (
        "spark.sql.shuffle.partitions",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = {k: spark.conf.get(k) for k in keys}
    monkeypatch.setattr(session, "bytes_below", lambda s, p: 100)
    with session.sized_for(spark, "small"):
        assert {k: spark.conf.get(k) for k in keys} == before
    monkeypatch.setattr(session, "bytes_below", lambda s, p: 100 * 10**12)
    with pytest.raises(ZeroDivisionError), session.sized_for(spark, "large"):
        assert int(spark.conf.get(keys[0])) == 100 * 10**12 // session.SHUFFLE_BYTES
        assert int(spark.conf.get(keys[1])) == int(spark.conf.get(keys[2])) == 10**9
        raise ZeroDivisionError
    assert {k: spark.conf.get(k) for k in keys} == before


def test_blocks_that_overlap_leave_the_settings_as_they_were(spark):
    """Threads enter and leave in any order; at the end nothing of their values is left."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    first, second = session.settings(spark, {key: "1000"}), session.settings(spark, {key: "2000"})
    first.__enter__()
    second.__enter__()
    assert spark.conf.get(key) == "2000"
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "2000"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == before
    session.at_once(spark, lambda i: [_use(spark, key, i) for _ in range(20)], list(range(1, 9)))
    assert spark.conf.get(key) == before


def _use(spark, key, i):
    with session.settings(spark, {key: str(i)}):
        assert spark.conf.get(key).isdigit()


def test_kept_rows_are_shared_and_can_be_discarded(spark, tmp_path, monkeypatch):
    kept = session.keep(spark.range(10), "some")
    assert kept.count() == 10
    session.discard(kept)
    with pytest.raises(Exception, match="(?i)not.?exist|not found"):
        kept.collect()


def test_a_cluster_needs_a_shared_folder():
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake)
    Fake.sparkContext.getCheckpointDir = staticmethod(lambda: "s3a://lake/scratch/")
    assert session.shared_folder(Fake) == "s3a://lake/scratch"

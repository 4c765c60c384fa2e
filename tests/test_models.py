import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from strandline.models import levels as levels_module
from strandline.models.features import encoder_stages, feature_names, level_names, one_hot_rows
from strandline.models.levels import encoded_rows, level_table
from strandline.models.scoring import high_risk, report, score, score_all
from strandline.models.training import feature_importance, train_forest, train_logistic
from strandline.operators.evaluate import roc_auc
from strandline.operators.split import stratified_split
from strandline.session import keep
from strandline.sources.zones import write_json
from tests.conftest import plan, rows

CATEGORICAL, NUMERIC, TARGET = ["dept"], ["age"], "y"


@pytest.fixture(scope="module")
def split(spark):
    """Readmission depends on age and department, with noise."""
    rng = np.random.default_rng(3)
    data = []
    for i in range(1200):
        age, dept = int(rng.integers(1, 95)), str(rng.choice(["A", "B", "C"]))
        p = 0.05 + 0.5 * (age > 60) + 0.2 * (dept == "B")
        data.append((i, dept, age, int(rng.random() < p)))
    df = spark.createDataFrame(data, "id int, dept string, age int, y int")
    marked = stratified_split(df, TARGET, ["id"]).cache()
    return marked.where("not is_test").drop("is_test"), marked.where("is_test").drop("is_test"), df


@pytest.fixture(scope="module")
def models(split):
    return {
        "lr": train_logistic(split[0], TARGET, CATEGORICAL, NUMERIC),
        "rf": train_forest(split[0], TARGET, CATEGORICAL, NUMERIC, trees=15, depth=4),
    }


def test_one_hot_rows_and_unknown_level(spark):
    train = spark.createDataFrame([(1, "b", "x"), (2, "a", "x")], "id int, c string, d string")
    model = Pipeline(stages=encoder_stages(["c", "d"])).fit(train)
    new = spark.createDataFrame([(3, "ZZZ", "x"), (4, None, None), (5, "a", "x")], train.schema)
    got = rows(one_hot_rows(model, new, "id"))
    assert got == [(3, "d", "x"), (5, "c", "a"), (5, "d", "x")]


def test_logistic_minimises_the_summed_loss_plus_half_the_norm(split, models):
    """Coefficients against Newton steps on that objective."""
    data = split[0].collect()
    x = np.array([[r.dept == "A", r.dept == "B", r.dept == "C", r.age, 1.0] for r in data], float)
    y = np.array([r.y for r in data], float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, penalty = np.zeros(5), np.diag([1.0, 1, 1, 1, 0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + penalty @ beta
        hessian = x.T @ (x * (w * p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    fitted = models["lr"].stages[-1]
    got = [*fitted.coefficients.toArray(), fitted.intercept]
    assert feature_names(models["lr"], NUMERIC) == ["dept_A", "dept_B", "dept_C", "age"]
    assert got == pytest.approx(beta.tolist(), rel=0.02, abs=0.01)


def test_both_models_find_the_signal(split, models):
    for model in models.values():
        scored = score(model, split[1]).cache()
        assert scored.columns == [*split[1].columns, "prediction", "score"]
        assert roc_auc(scored, TARGET, "score").first()[0] > 0.7


def test_importance_ranks_age_first(split, models):
    ranked = feature_importance(models["rf"], NUMERIC, split[1]).orderBy(F.desc("importance")).collect()
    assert ranked[0].feature == "age" and sum(r.importance for r in ranked) == pytest.approx(1)


def test_report_is_one_json_document(spark, split, models, tmp_path):
    _, test, everything = split
    scored = score_all(models, test, str(tmp_path / "predictions"))
    out = report(
        scored, everything, TARGET, "lr", "rf", feature_importance(models["rf"], NUMERIC, scored), features=2
    )
    write_json(out, str(tmp_path / "report"))
    (line,) = [
        text for f in (tmp_path / "report").glob("*.json") for text in f.read_text().splitlines()
    ]
    doc = json.loads(line)
    assert doc["test_size"] == test.count() == sum(map(sum, doc["confusion_matrix_rf"]))
    matrix, hits = doc["confusion_matrix_rf"], doc["random_forest"]["accuracy"]
    assert hits == pytest.approx((matrix[0][0] + matrix[1][1]) / doc["test_size"], abs=5e-4)
    assert 0.5 < doc["logistic_regression"]["roc_auc"] <= 1
    assert doc["positive_rate"] == round(everything.agg(F.avg(TARGET)).first()[0], 3)
    assert [f["feature"] for f in doc["top_features"]][0] == "age" and len(doc["top_features"]) == 2


def test_high_risk_table(spark, split, models, tmp_path):
    scored = score(models["lr"], split[1])
    got = high_risk(scored, str(tmp_path / "risk"), threshold=0.6)
    want = scored.where("score >= 0.6")
    assert rows(got) == rows(want) and 0 < got.count() < split[1].count()


def test_unknown_category_is_scored(spark, models):
    new = spark.createDataFrame([(1, "ZZZ", 50, 0)], "id int, dept string, age int, y int")
    assert 0 < score(models["lr"], new).first().score < 1


def test_rows_without_a_number_are_left_out_of_the_fit_and_kept_in_the_scores(spark, split, models):
    holes = split[0].unionByName(split[0].limit(50).withColumn("age", F.lit(None).cast("int")))
    again = train_logistic(holes, TARGET, CATEGORICAL, NUMERIC)
    assert again.stages[-1].coefficients.toArray() == pytest.approx(
        models["lr"].stages[-1].coefficients.toArray(), rel=1e-6
    )
    new = spark.createDataFrame([(1, "A", None, 0), (2, None, 50, 1), (3, "A", 50, 1)], split[0].schema)
    for model in models.values():
        got = {r.id: (r.prediction, r.score) for r in score(model, new).collect()}
        assert got[1] == (None, None) and None not in got[2] + got[3]


# --- the level dictionary as a table ---


def test_levels_are_those_of_the_encoder(spark):
    made = [(i, w, x) for i, (w, x) in enumerate([("b", "é"), ("a", None), (None, "Z"), ("a", "z"), ("_", "e"), ("B", "Z")])]
    df = spark.createDataFrame(made, "id long, w string, x string").repartition(3)
    levels = level_table(df, ["x", "w"])
    model = Pipeline(stages=encoder_stages(["x", "w"])).fit(df)
    wanted = [("x", v) for v in level_names(model)["x"]] + [("w", v) for v in level_names(model)["w"]]
    assert [(r["feature"], r["level"]) for r in levels.orderBy("slot").collect()] == wanted
    assert sorted(r["slot"] for r in levels.collect()) == list(range(len(wanted)))
    new = df.unionByName(spark.createDataFrame([(9, "unseen", "Z"), (10, None, None)], "id long, w string, x string"))
    stored = keep(levels)
    got = encoded_rows(new, stored, ["x", "w"], "id")
    assert rows(got.drop("slot")) == rows(one_hot_rows(model, new, "id").select("id", "feature", "level"))


def test_an_empty_dictionary(spark):
    df = spark.createDataFrame([(1, None)], "id long, w string")
    levels = keep(level_table(df, ["w"]))
    assert levels.count() == 0 and encoded_rows(df, levels, ["w"], "id").count() == 0


def test_a_million_levels(spark, monkeypatch):
    """Beyond the size for a broadcast rows meet the dictionary by a join; a third of them have one level."""
    n = 1_000_000
    df = spark.range(n).selectExpr("id", "format_string('%07d', id) AS w", "IF(id % 3 = 0, 'often', CAST(id % 50 AS STRING)) AS x")
    levels = keep(level_table(df, ["w", "x"]))
    ends = levels.agg(F.count("slot"), F.countDistinct("slot"), F.min("slot"), F.max("slot")).first()
    assert tuple(ends) == (n + 51, n + 51, 0, n + 50)
    assert levels.where("feature = 'w' AND slot <> CAST(level AS BIGINT)").count() == 0
    monkeypatch.setattr(levels_module, "BROADCAST_BYTES", 0)
    some = df.where("id % 10 = 0")
    got = encoded_rows(some, levels, ["w", "x"], "id")
    assert "SortMergeJoin [" in plan(got)
    assert got.count() == 2 * n // 10 and got.where("feature = 'w' AND slot <> id").count() == 0

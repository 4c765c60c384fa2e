"""The forest as a table of nodes against the fitted model itself."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.models.scoring import score
from strandline.models.training import feature_importance, train_forest
from strandline.models.trees import forest_scores, leaves, node_importance, node_table
from tests.conftest import plan, rows

SCHEMA = "id long, kind string, size double, age int, label int, tree int, node int"


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(4)
    made = []
    for i in range(400):
        kind, size, age = draw.choice(["a", "b", "c", None]), draw.uniform(0, 10), draw.randint(0, 90)
        label = int(draw.random() < 0.1 + 0.5 * (kind == "a") + 0.3 * (size > 6))
        made.append((i, kind, size, age, label, 7, 7))
    return spark.createDataFrame(made, SCHEMA).persist()


@pytest.fixture(scope="module")
def fitted(spark, table):
    model = train_forest(table, "label", ["kind"], ["size", "age"], trees=20, depth=5, bins=32)
    return model, node_table(spark, model)


def odd_rows(spark):
    """Unseen and missing levels, missing numbers, values beyond those of the fit."""
    return spark.createDataFrame(
        [
            (1000, "zz", 5.0, 30, 0, 1, 1), (1001, None, -1e9, 30, 0, 1, 1), (1002, "a", 1e9, 400, 0, 1, 1),
            (1003, "b", None, 30, 0, 1, 1), (1004, "b", 2.0, None, 0, 1, 1), (1005, "c", float("nan"), 3, 0, 1, 1),
        ],
        SCHEMA,
    )


def test_scores_are_those_of_the_model(spark, table, fitted):
    model, nodes = fitted
    test = table.unionByName(odd_rows(spark))
    want = {r["id"]: (r["prediction"], r["score"]) for r in score(model, test).collect()}
    got = {r["id"]: r for r in forest_scores(model, nodes, test, "id").collect()}
    assert set(want) - set(got) == {1003, 1004, 1005}
    assert all(want[i] == (None, None) for i in (1003, 1004, 1005))
    for i, r in got.items():
        assert r["trees"] == 20
        assert r["score"] == pytest.approx(want[i][1], abs=1e-12)
        assert r["prediction"] == want[i][0] or r["score"] == pytest.approx(0.5)


def test_importances_are_those_of_the_model(spark, table, fitted):
    model, nodes = fitted
    want = dict(rows(feature_importance(model, ["size", "age"], table)))
    got = dict(rows(node_importance(spark, model, nodes)))
    assert got == pytest.approx(want, abs=1e-12) and sum(got.values()) == pytest.approx(1)


def test_nodes_hold_together(fitted):
    _, nodes = fitted
    inner = nodes.where("feature IS NOT NULL").alias("p")
    for side in ("left", "right"):
        child = nodes.select("tree", F.col("node").alias(f"{side}_node"), F.col("weight").alias(f"{side}_weight"))
        inner = inner.join(child, ["tree", f"{side}_node"])
    assert inner.where("abs(weight - left_weight - right_weight) > 1e-9").count() == 0
    assert inner.count() == nodes.where("feature IS NOT NULL").count()
    assert nodes.groupBy("tree").count().count() == 20
    # a number has a threshold, a level the values that go left
    assert nodes.where("feature IS NOT NULL AND (left_values IS NULL) = (threshold IS NULL)").count() == 0
    assert nodes.where("threshold IS NOT NULL").count() > 0 < nodes.where("left_values IS NOT NULL").count()


def test_every_row_reaches_one_leaf_of_every_tree(spark, table, fitted):
    model, nodes = fitted
    values = table.select("id", F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0), "size", F.col("age").cast("double")).alias("x"))
    reached = leaves(nodes, values, "id", "x", 20, 5)
    assert reached.groupBy("id").count().where("count <> 20").count() == 0
    # nodes are broadcast, and rows are not shuffled on the way down
    assert "SortMergeJoin" not in plan(reached) and "hashpartitioning(tree" not in plan(reached)


def test_a_forest_without_a_split(spark):
    same = spark.createDataFrame([(i, "a", 1.0, 5, i % 2, 0, 0) for i in range(20)], SCHEMA)
    model = train_forest(same, "label", ["kind"], ["size"], trees=3, depth=2)
    nodes = node_table(spark, model)
    assert nodes.count() == 3 and nodes.where("feature IS NOT NULL").count() == 0
    assert {r["importance"] for r in node_importance(spark, model, nodes).collect()} == {0.0}
    want = {r["id"]: r["score"] for r in score(model, same).collect()}
    got = {r["id"]: r["score"] for r in forest_scores(model, nodes, same, "id").collect()}
    assert got == pytest.approx(want)

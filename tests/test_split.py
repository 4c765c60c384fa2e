from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.operators.split import class_weights, stratified_split
from tests.conftest import rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(3001).select("id", F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("y")).cache()


def brute_force(df, fraction, seed=42):
    import hashlib

    by_class = {}
    for r in df.collect():
        by_class.setdefault(r.y, []).append((hashlib.md5(f"{seed}|{r.id}".encode()).hexdigest(), r.id))
    out = set()
    for members in by_class.values():
        out |= {i for _, i in sorted(members)[: int(len(members) * fraction + 0.5)]}
    return out


@pytest.mark.parametrize("leaf_rows", [1_000_000, 1, 0])
def test_exact_counts_at_any_depth(labelled, leaf_rows):
    df = labelled
    got = stratified_split(df, "y", ["id"], leaf_rows=leaf_rows)
    assert {r.id for r in got.where("is_test").collect()} == brute_force(df, 0.25)
    assert got.count() == 3001


def test_other_seed_other_rows_same_counts(labelled):
    a = stratified_split(labelled, "y", ["id"], seed=1).where("is_test")
    b = stratified_split(labelled, "y", ["id"], seed=2).where("is_test")
    assert Counter(r.y for r in a.collect()) == Counter(r.y for r in b.collect()) == {0: 600, 1: 150}
    assert a.join(b, "id").count() < 750


def test_copies_of_a_key_stay_on_one_side(spark):
    ids = [0] * 40 + list(range(1, 61))
    df = spark.createDataFrame([(i, 0) for i in ids], "id long, y int")
    got = stratified_split(df, "y", ["id"], leaf_rows=10)
    sides = got.groupBy("id").agg(F.countDistinct("is_test").alias("n")).where("n > 1")
    assert sides.count() == 0 and got.count() == 100
    assert got.where("is_test").count() <= 25


def test_tiny_classes_and_missing_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "b")], "id long, y string")
    got = {r.id: r.is_test for r in stratified_split(df, "y", ["id"]).collect()}
    assert got[1] is False and got[2] is None
    assert sorted([got[3], got[4]]) == [False, True]


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, y int")
    assert stratified_split(empty, "y", ["id"]).count() == 0


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2 + [(None,)], "y int")
    assert rows(class_weights(df, "y")) == [(0, 6, 8 / 12), (1, 2, 2.0)]


def test_the_input_is_run_twice_at_most(spark):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        runs.add(1)
        return x

    df = spark.range(100).select(seen("id").alias("id"), (F.col("id") % 2).alias("y"))
    assert stratified_split(df, "y", ["id"], leaf_rows=1).count() == 100
    before = runs.value
    assert stratified_split(df, "y", ["id"], leaf_rows=1).collect() and runs.value - before <= 200

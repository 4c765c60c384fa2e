import math
import random

import pytest

from strandline.operators.evaluate import accuracy, confusion, roc_auc, roc_curve
from tests.conftest import rows


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)
    out = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(600)]
    return out + [(i % 2, 0.5) for i in range(300)]  # a third of all rows ties


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double")


@pytest.mark.parametrize("pieces", [None, 1, 10, 200])
def test_auc_for_any_number_of_ranges(spark, pairs, pieces):
    (got,) = roc_auc(frame(spark, pairs), "y", "s", pieces).first()
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)


@pytest.mark.parametrize("pieces", [1, 3, 50])
def test_odd_scores_count_alike_for_any_number_of_ranges(spark, pairs, pieces):
    known = [*pairs, (1, math.inf), (0, math.inf), (0, -math.inf), (1, -math.inf), (1, 0.0), (0, -0.0)]
    odd = [(1, math.nan), (0, math.nan), (1, None), (None, 0.4)]
    (got,) = roc_auc(frame(spark, known + odd), "y", "s", pieces).first()
    assert got == pytest.approx(brute_auc(known), abs=1e-12)
    curve = roc_curve(frame(spark, known + odd), "y", "s", pieces).collect()
    assert len(curve) == len({s for _, s in known}) + 1
    assert max(r.tpr for r in curve) == max(r.fpr for r in curve) == 1.0


def test_metrics_of_no_rows(spark):
    assert roc_auc(frame(spark, []), "y", "s").first()[0] is None
    assert rows(roc_curve(frame(spark, []), "y", "s")) == [(math.inf, 0.0, 0.0)]


def test_ties_count_one_half(spark):
    assert roc_auc(frame(spark, [(1, 0.5), (0, 0.5)]), "y", "s").first()[0] == 0.5


def test_auc_without_a_class_is_null(spark):
    assert roc_auc(frame(spark, [(1, 0.5), (1, 0.7)]), "y", "s").first()[0] is None


def test_curve_in_buckets_is_the_curve(spark, pairs):
    df = frame(spark, pairs)
    whole, cut = roc_curve(df, "y", "s"), roc_curve(df, "y", "s", pieces=70)
    assert rows(whole) == rows(cut)
    points = sorted(whole.collect(), key=lambda r: -r.threshold)
    assert tuple(points[0]) == (math.inf, 0.0, 0.0)
    assert (points[-1].fpr, points[-1].tpr) == (1.0, 1.0)
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(brute_auc(pairs), abs=1e-12)
    p, n = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    for r in points[1:]:
        assert r.tpr == sum(y == 1 and s >= r.threshold for y, s in pairs) / p
        assert r.fpr == sum(y == 0 and s >= r.threshold for y, s in pairs) / n


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "y int, p int")
    assert rows(confusion(df, "y", "p")) == [(0, 2, 1), (1, 0, 0)]
    assert accuracy(df, "y", "p").first()[0] == pytest.approx(2 / 3)

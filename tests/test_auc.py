"""AUC beyond what a long holds, and on scores that lie unevenly."""

import random

import pytest
from pyspark.sql import functions as F

from delaylake.operators import evaluate as E


def brute(hist):
    below, top = 0, 0
    for _, p, n in sorted(hist):
        top += 2 * p * below + p * n
        below += n
    return top / (2 * sum(p for _, p, _ in hist) * below)


def test_ten_billion_rows_of_each_label(spark):
    hist = [(i / 10, 10 ** 9 + i, 10 ** 9 - 7 * i) for i in range(10)]
    got = E.histogram_auc(spark.createDataFrame(hist, "__s double, __pos long, __neg long"), 0.5).first()
    assert got["auc"] == pytest.approx(brute(hist), abs=1e-12)
    assert 0.49 < got["accuracy"] < 0.51


@pytest.mark.parametrize("shape", ["outlier", "cluster", "infinite"])
def test_uneven_scores_are_spread_over_tasks(spark, shape):
    rnd = random.Random(3)
    scores = {"outlier": [rnd.random() for _ in range(3000)] + [1e12],
              "cluster": [0.5 + rnd.random() * 1e-9 for _ in range(3000)] + [0.0, 1.0],
              "infinite": [rnd.gauss(0, 1) for _ in range(3000)] + [float("inf"), float("-inf")]}[shape]
    hist = [(s, rnd.randrange(4), rnd.randrange(4)) for s in set(scores)]
    df = spark.createDataFrame(hist, "__s double, __pos long, __neg long")
    assert E.histogram_auc(df).first()["auc"] == pytest.approx(brute(hist), abs=1e-12)
    sizes = [r["count"] for r in df.repartitionByRange(8, "__s").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)


def test_one_label_or_no_rows(spark):
    schema = "delay_label int, score double"
    assert E.auc(spark.createDataFrame([], schema)).first()["auc"] is None
    assert E.auc(spark.createDataFrame([(1, 0.5), (1, None)], schema)).first()["auc"] is None

"""The squared-hinge solver, its folds and its sigmoid against dense brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylake.operators import models as M
from delaylake.operators import sampling as S
from delaylake.operators import svm

NUMERIC, CATS = ["a", "b", "p"], ["air", "slot"]


def make(n=2000, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        air, slot = rnd.choice("ABCDE"), rnd.choice(["m", "n", None])
        a, b, p = rnd.gauss(0, 3), rnd.random(), 1013 + rnd.gauss(0, 9)
        score = 0.4 * a + (air == "A") - (slot == "n") + 0.05 * (p - 1013) + rnd.gauss(0, 1.5)
        rows.append((i, air, slot, a, b, p, int(score > 0.8)))
    return rows


SCHEMA = "k int, air string, slot string, a double, b double, p double, y int"


def dense(rows, inputs):
    """Standardised inputs with the constant last."""
    x = []
    for r in rows:
        row = dict(zip(["k", "air", "slot", "a", "b", "p", "y"], r))
        x.append([row[c] for c in NUMERIC] + [float(row[c] == v) for c, vs in inputs.cats.items() for v in vs])
    x = np.array(x)
    s = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(s > 0, s, 1)
    return np.hstack([z, np.ones((len(z), 1))])


def minimiser(z, y, c, cost):
    """Gradient descent with a step below the inverse of the largest curvature: slow and plain."""
    theta = np.zeros(z.shape[1])
    step = 1 / (1 + 2 * cost * np.linalg.eigvalsh((z * c[:, None]).T @ z)[-1])
    seen, last = theta, theta
    for k in range(200_000):
        slack = np.maximum(0, 1 - y * (z @ seen))
        new = seen - step * (seen - 2 * cost * z.T @ (c * y * slack))
        seen, last = new + k / (k + 3) * (new - last), new
        if k % 500 == 499:
            slack = np.maximum(0, 1 - y * (z @ new))
            if np.abs(new - 2 * cost * z.T @ (c * y * slack)).max() < 1e-8:
                break
    return new


@pytest.fixture(scope="module")
def fitted(spark):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    inputs = svm.fit_inputs(df, NUMERIC, CATS)
    return rows, df, inputs


def test_weights_equal_a_brute_force_minimiser(fitted):
    rows, df, inputs = fitted
    enc = svm.encoded(df, inputs, "y", ["k"]).withColumn("member", F.explode(F.array(F.lit(0), F.lit(1))))
    enc = enc.where("member = 0 or k % 3 > 0").withColumn(
        "c", F.when(F.col("member") == 0, F.when(F.col("y") > 0, 1.7).otherwise(0.8)).otherwise(1.0))
    theta = svm.squared_hinge(enc, inputs, 2, 0.1)
    z, y = dense(rows, inputs), np.array([2 * r[6] - 1 for r in rows])
    some = np.array([r[0] % 3 > 0 for r in rows])
    want = [minimiser(z, y, np.where(y > 0, 1.7, 0.8), 0.1), minimiser(z[some], y[some], np.ones(some.sum()), 0.1)]
    assert np.abs(theta - np.array(want)).max() < 1e-4


def test_members_score_raw_rows_like_the_solver(fitted):
    rows, df, inputs = fitted
    theta = np.random.default_rng(1).normal(size=inputs.size + 1)
    member = svm.LinearMember.of(inputs, theta, 1.5, -0.2)
    again = svm.LinearMember.from_rows([dict(zip(["member", "kind", "input", "value", "weight"], r))
                                        for r in member.rows(0)])
    got = {r["k"]: r["f"] for r in df.select("k", again.margin().alias("f")).collect()}
    assert np.allclose([got[r[0]] for r in rows], dense(rows, inputs) @ theta, atol=1e-9)
    unknown = df.limit(1).withColumn("air", F.lit("?")).select(again.margin().alias("f"), "a", "b", "p", "slot").first()
    want = member.intercept + sum(member.numeric[c] * unknown[c] for c in NUMERIC) + member.cats["slot"].get(
        unknown["slot"], 0)
    assert unknown["f"] == pytest.approx(want)


def test_sigmoid_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = [(k, y, float(rnd.randint(1, 3)), y * 0.7 + rnd.gauss(0, 1 + k)) for k in (0, 1)
            for y in (-1, 1) for _ in range(150)]
    rows += [(2, 1, 1.0, 5.0), (2, -1, 1.0, -5.0)]           # separable: stays finite
    got = svm.sigmoid(spark.createDataFrame(rows, "member int, y int, n double, f double"), 3)
    for k in range(3):
        y, n, f = (np.array([r[i] for r in rows if r[0] == k]) for i in (1, 2, 3))
        up, down = n[y > 0].sum(), n[y < 0].sum()
        t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
        p = 1 / (1 + np.exp(-(got[k][0] * f + got[k][1])))
        assert abs((n * (p - t) * f).sum()) < 1e-4 and abs((n * (p - t)).sum()) < 1e-4


def test_folds_are_stratified_and_copies_are_dealt(spark):
    rows = [(i, i % 7 == 0, "x") for i in range(200)] + [(500, True, "copy")] * 101 + [(None, None, None)] * 4
    df = spark.createDataFrame(rows, "k int, y boolean, v string").repartition(5)
    got = S.stratified_folds(df, "y", ["k"], 3)
    assert Counter((r["k"], r["y"], r["v"]) for r in got.collect()) == Counter(rows)
    counts = Counter((r["y"], r["fold"]) for r in got.collect())
    for label in (True, False, None):
        n = [counts[label, f] for f in range(3)]
        assert max(n) - min(n) <= 1
    again = S.stratified_folds(df.repartition(2), "y", ["k"], 3)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, again.collect()))


def test_calibrated_svm_learns_and_is_saved(spark, fitted, tmp_dir):
    rows, df, _ = fitted
    more = df.union(spark.createDataFrame([(9000, "A", "m", None, 1.0, 1000.0, 1)], SCHEMA))
    model = M.svm_calibrated(more, ["k"], label="y", numeric=NUMERIC, cats=CATS)
    M.save_model(model, tmp_dir + "/svm")
    scored = M.load_model(tmp_dir + "/svm").transform(more)
    from pyspark.ml.functions import vector_to_array
    got = scored.select("y", "prediction", vector_to_array("probability")[1].alias("p")).collect()
    assert len(got) == len(rows)                      # the row without an input is left out
    base = np.mean([r["y"] for r in got])
    assert np.mean([r["y"] == r["prediction"] for r in got]) > max(base, 1 - base) + 0.1
    assert abs(np.mean([r["p"] for r in got]) - np.mean([r["y"] for r in got])) < 0.03

import os

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from delaylake.operators import features as FE
from delaylake.operators import forest as B
from delaylake.operators import models as M
from delaylake.operators.trees import Grid
from tests.test_models_stream import _planted


def _p(model, df):
    return {r["k"]: r["p"] for r in model.transform(df).select(
        "k", vector_to_array("probability")[1].alias("p")).collect()}


def _brute(tests, y, n, w, left, min_rows):
    """Each row's leaf share: at every node the test of least weighted Gini impurity."""
    def leaf(rows, left):
        mass = lambda r, k: (n * w)[r & (y == k)].sum()
        pure = lambda r: sum(mass(r, k) ** 2 for k in (0, 1)) / max((n * w)[r].sum(), 1e-300)
        out = np.where(rows, mass(rows, 1) / (n * w)[rows].sum(), 0.0)
        fit = [p for p in tests if min(n[rows & p].sum(), n[rows & ~p].sum()) >= min_rows]
        if not left or not fit:
            return out
        p = max(fit, key=lambda p: pure(rows & p) + pure(rows & ~p))
        if pure(rows & p) + pure(rows & ~p) <= pure(rows) + 1e-9:
            return out
        return leaf(rows & p, left - 1) + leaf(rows & ~p, left - 1)
    return leaf(np.ones(len(y), bool), left)


@pytest.mark.parametrize("even", [True, False])
def test_a_tree_takes_the_splits_of_least_impurity(even, monkeypatch):
    monkeypatch.setattr(B, "NODES", 3)      # a level's nodes in several parts
    rng = np.random.default_rng(5)
    m = 400
    grid = Grid(["a", "b"], ["c"], [[float(i) for i in range(9)], [0.0, 1.0]], [["u", "v", "w"]], True)
    bins = np.stack([rng.integers(0, 10, m), rng.integers(0, 3, m), rng.integers(0, 4, m)]).astype(np.uint8)
    y = ((bins[0] > 5) ^ (bins[2] == 1) ^ (rng.random(m) < 0.2)).astype(np.uint8)
    n = rng.integers(1, 4, m).astype(float)
    w = np.where(y == 1, 2.5, 0.75) if even else rng.random(m) + 0.5
    rule = B.Rule(grid, 99, 4, 5, 1)
    tree = B.grown(rule, bins, y, n, w, 0, rng)
    tests = [bins[0] > i for i in range(9)] + [bins[1] > i for i in range(2)] + [bins[2] == i for i in range(3)]
    got = tree["value"][B.walked(tree, bins, 5)]
    assert got == pytest.approx(_brute(tests, y, n, w, 5, 4), abs=1e-6)


def test_forest_is_the_same_however_its_nodes_are_grown(spark, monkeypatch):
    df = _planted(spark, n=400).repartition(2, "k").cache()
    fit = lambda: B.block_forest(df, "delay_label", None, M.CLASSIFIER_NUMERIC, M.K.CATEGORICAL_COLS,
                                 1, 6, 2, 7)       # a single tree tries all features
    whole = _p(fit(), df)
    monkeypatch.setattr(B, "UNIT_ROWS", 40)        # the upper nodes by sums, the rest by rows
    apart = _p(fit(), df)
    assert whole == pytest.approx(apart, abs=1e-6) and len(set(whole.values())) > 3


def test_large_forest_is_grown_over_blocks_in_batches(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(M, "GROWN_ROWS", 1)
    monkeypatch.setattr(B, "BATCH_ROWS", 2000)      # a few trees at once
    df = _planted(spark, n=400).where("delay_label = 0 or k % 3 = 0").cache()
    model = M.rf_classifier(FE.with_class_weights(df), num_trees=20, max_depth=6, min_instances=2, weight_col="weight")
    assert isinstance(model, B.BlockForest) and len(model.trees) == 20
    assert len({t.tobytes() for t in model.trees}) == 20
    path = os.path.join(tmp_dir, "forest")
    M.save_model(model, path)
    p = _p(model, df)
    assert _p(M.load_model(path), df) == p
    plain = _p(M.rf_classifier(df, num_trees=20, max_depth=6, min_instances=2), df)
    assert np.mean(list(p.values())) > np.mean(list(plain.values()))
    monkeypatch.setattr(M, "GROWN_ROWS", 10 ** 9)
    other = _p(M.rf_classifier(FE.with_class_weights(df), num_trees=20, max_depth=6, min_instances=2,
                               weight_col="weight"), df)
    assert np.corrcoef([p[k] for k in p], [other[k] for k in p])[0, 1] > 0.8     # MLlib's forest
    s = model.transform(df).select("prediction", vector_to_array("probability").alias("q"))
    assert s.where((F.col("prediction") == 1) != (F.col("q")[1] > 0.5)).count() == 0
    assert s.where(F.abs(F.col("q")[0] + F.col("q")[1] - 1) > 1e-9).count() == 0

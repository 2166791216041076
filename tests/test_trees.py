import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylake.operators import models as M
from delaylake.operators import score as SC
from delaylake.operators import trees as T


def _rows(spark, n=300):
    """x has many values, m few, c three categories and nulls; y follows all of them."""
    d = spark.range(n).select(
        F.col("id").alias("k"), ((F.col("id") * 37) % 101 / 7.0).alias("x"), (F.col("id") % 4).alias("m"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("c"))
    late = F.when(F.col("c") == "c1", 40.0).when(F.col("c").isNull(), -25.0).otherwise(0.0)
    return d.withColumn("y", late + F.when(F.col("x") > 9, 30.0).otherwise(0.0) + 5.0 * F.col("m"))


def _fit(df, max_iter=1, depth=2, subsample=1.0, **kw):
    return T.boosted_trees(df, "y", ["x", "m"], ["c"], max_iter, depth, 0.1, subsample, 7, **kw)


def _brute(parts, y, depth):
    """Mean of each row's leaf: splits by every test of ``parts`` (boolean arrays) at every node."""
    def leaf(rows, left):
        best = max(((y[rows & p].sum() ** 2 / (rows & p).sum() + y[rows & ~p].sum() ** 2 / (rows & ~p).sum(), i)
                    for i, p in enumerate(parts) if (rows & p).any() and (rows & ~p).any()), default=None)
        if not left or best is None or best[0] <= y[rows].sum() ** 2 / rows.sum() + 1e-9:
            return np.where(rows, y[rows].mean(), 0.0)
        p = parts[best[1]]
        return leaf(rows & p, left - 1) + leaf(rows & ~p, left - 1)
    return leaf(np.ones(len(y), bool), depth)


def test_boosted_tree_takes_the_best_splits(spark):
    df = _rows(spark)
    d = df.orderBy("k").toPandas()
    model = _fit(df, depth=3)
    cuts = [d["x"].to_numpy() > c for c in model.grid.cuts[0]] + [d["m"].to_numpy() > c for c in (0.5, 1.5, 2.5)]
    cats = [(d["c"] == c).to_numpy() for c in ("c0", "c1", "c2")] + [d["c"].isna().to_numpy()]
    want = _brute(cuts + cats, d["y"].to_numpy(), 3)
    got = model.transform(df).orderBy("k").toPandas()["prediction"].to_numpy()
    assert model.grid.cuts[1] == [0.5, 1.5, 2.5] and len(model.grid.cuts[0]) <= T.MAX_BINS - 1
    assert got == pytest.approx(want, abs=1e-3)


def test_boosted_trees_do_not_depend_on_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "RESTATE", 2)        # residuals are kept anew and written on the way
    monkeypatch.setattr(T, "CUT", 4)
    df = _rows(spark)
    one = _fit(df.repartition(1), max_iter=7)
    monkeypatch.setattr(T, "BLOCK_ROWS", 16)
    many = _fit(df.repartition(5), max_iter=7)
    assert len(one.trees) == len(many.trees) == 7
    p = [m.transform(df).orderBy("k").toPandas()["prediction"].to_numpy() for m in (one, many)]
    assert p[0] == pytest.approx(p[1], abs=1e-2)
    y = df.orderBy("k").toPandas()["y"].to_numpy()
    assert np.abs(p[0] - y).mean() < np.abs(_fit(df).transform(df).orderBy("k").toPandas()["prediction"] - y).mean()


def test_boosted_trees_are_saved_and_score_unknown_and_missing_values(spark, tmp_dir):
    model = _fit(_rows(spark), max_iter=3, subsample=0.8)
    path = os.path.join(tmp_dir, "trees")
    M.save_model(model, path)
    loaded = M.load_model(path)
    assert isinstance(loaded, T.BoostedTrees)
    odd = spark.createDataFrame([(1, 3.0, 2, "c1"), (2, 3.0, 2, "new"), (3, 3.0, 2, None), (4, None, 2, "c1"),
                                 (5, 1e9, -7, "c0")], "k long, x double, m long, c string")
    got = {r["k"]: r["prediction"] for r in loaded.transform(odd).collect()}
    assert got == {r["k"]: r["prediction"] for r in model.transform(odd).collect()}
    assert set(got) == {1, 2, 3, 5} and got[2] == got[3] != got[1]


def test_regressor_keeps_a_byte_a_column_and_sums_of_fixed_size(spark):
    df = _rows(spark, 5000)
    grid, n = T.fit_grid(df, ["x", "m"], ["c"])
    assert n == 5000 and grid.sizes == [len(grid.cuts[0]) + 1, 4, 4]
    rows = df.select(*grid.inputs(), "y").coalesce(1)
    from functools import partial
    blocks = rows.mapInArrow(partial(T._packed, grid=grid, size=2000), T.BLOCK).collect()
    assert [len(b["bins"]) for b in blocks] == [6000, 6000, 3000] and [len(b["r"]) for b in blocks] == [8000, 8000, 4000]
    assert len({b["block"] for b in blocks}) == 3


def test_cuts_are_half_way_and_few_values_keep_them_all():
    assert T._cuts(np.array([3.0, 1.0, 1.0, 2.0]), 32) == [1.5, 2.5]
    assert T._cuts(np.array([4.0, 4.0]), 32) == []
    cuts = T._cuts(np.arange(1000.0), 32)
    assert len(cuts) == 31 and all(20 < b - a < 45 for a, b in itertools.pairwise(cuts))
    assert T._cuts(np.array([0.0] * 999 + list(range(1, 40))), 32)[0] == 0.5


def test_minutes_are_those_of_the_binned_trees(spark):
    df = _rows(spark, 120).withColumn("risk", F.element_at(F.array(*map(F.lit, ("low", "medium", "high"))),
                                                           (F.col("k") % 3 + 1).cast("int")))
    model = _fit(df, max_iter=4)
    scored = model.transform(df)
    assert scored.columns == [*df.columns, "prediction"]       # one column, no vector of one-hot slots
    want = {r["k"]: max(0, round(r["prediction"])) if r["k"] % 3 else None for r in scored.collect()}
    got = {r["k"]: r["est_delay_mins"] for r in SC.conditional_minutes(df, model).collect()}
    assert got == want and any(want.values())

"""Exact quantiles by narrowing against ``percentile``."""

import math
import random

import pytest
from pyspark.sql import functions as F

from delaylake.operators import aggregates as A
from delaylake.operators import clean as CL
from delaylake.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.02, 0.37, 0.5, 0.98, 1.0]


def same(a, b):
    if a is None or b is None:
        return a is b
    return len(a) == len(b) and all(x == y or (math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))


def test_million_distinct_doubles_with_ties_nulls_nan_and_infinities(spark):
    x = (F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 1009 == 0, float("nan"))
         .when(F.col("id") % 5003 == 1, float("inf")).when(F.col("id") % 5003 == 2, float("-inf"))
         .when(F.col("id") % 13 == 0, 0.25).when(F.col("id") == 17, 1e300)
         .otherwise(F.rand(5) * F.pow(F.lit(10.0), F.col("id") % 9)))
    df = spark.range(1_000_000, numPartitions=6).select(x.alias("x"), (F.col("id") % 3).alias("g")).cache()
    got = exact_quantiles(df, ["x"], PROBS, window=1000).first()["x"]
    want = df.agg(F.percentile("x", F.array(*map(F.lit, PROBS)))).first()[0]
    assert same(got, want)
    got = {r["g"]: r["x"] for r in exact_quantiles(df, ["x"], PROBS, ["g"], window=1000).collect()}
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, PROBS))).alias("q")).collect()}
    assert got.keys() == want.keys() and all(same(got[k], want[k]) for k in want)


@pytest.mark.parametrize("window", [1, 1000])
def test_small_groups_null_keys_and_columns_without_values(spark, window):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), float(rnd.choice([1, 2, 2, 3, 7])), None)
            for _ in range(60)] + [("only", 1, None, None), ("one", 1, 5.0, None)]
    df = spark.createDataFrame(rows, "k string, m int, x double, y double")
    got = {(r["k"], r["m"]): (r["x"], r["y"]) for r in exact_quantiles(df, ["x", "y"], PROBS, ["k", "m"], window).collect()}
    want = {(r["k"], r["m"]): r["q"] for r in df.groupBy("k", "m").agg(
        F.percentile("x", F.array(*map(F.lit, PROBS))).alias("q")).collect()}
    assert got.keys() == want.keys()
    assert all(same(got[k][0], want[k]) and got[k][1] is None for k in want)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert exact_quantiles(df, ["x"], [0.5], ["k"]).collect() == []
    assert [r["x"] for r in exact_quantiles(df, ["x"], [0.5]).collect()] in ([], [None])


def test_operators_agree_with_their_value_maps(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.choice("xy"), rnd.choice([None, rnd.gauss(0, 9), 2.0]), "s") for _ in range(400)]
    df = spark.createDataFrame(rows, "Dep_Airport string, Arr_Airport string, v double, Distance_type string")
    rows_of = lambda d: sorted(map(tuple, d.collect()), key=str)
    for f in (lambda e: CL.impute_global_median(df, ["v"], exact=e), lambda e: A.winsorize_quantile(df, "v", exact=e),
              lambda e: A.quantile_filter(df, "v", 0.9, exact=e), lambda e: A.median_age(df, "v", exact=e),
              lambda e: A.route_stats(df.withColumnRenamed("v", "Flight_Duration"), exact=e)):
        assert rows_of(f(True)) == rows_of(f("ranges"))

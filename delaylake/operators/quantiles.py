"""Exact quantiles of columns with any number of distinct values, also by group.

``percentile`` and ``median`` keep a value -> count map per group that ends up in one reducer:
right for minutes and 2-decimal readings, not for a billion distinct doubles. Here the values
of a column are counted in a distributed table (a row for each distinct value, ties and hot
values collapse map-side), and the order statistics that a quantile needs are found in it by
narrowing: 63 splitters from a fixed-size sketch cut the range that holds a rank into
intervals, an exact histogram of the intervals says which one holds it, and only that one is
looked at again. As soon as the ranges hold at most ``window`` distinct values each, a running
count over those values ends the search. The sketch only chooses where to cut: whatever it
says, the counts, and so the result, are exact.

Nulls are no values. NaN is larger than any other value, as in Spark's order. Quantiles are
interpolated linearly, like ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.session import materialize

SPLITTERS = 63
WINDOW = 1_000_000       # distinct values that one task ranks
_ACCURACY = 1000


def _narrowed(counts: DataFrame, targets: DataFrame, g: list[str]) -> DataFrame:
    """Targets (g, rank, low, high, below, width) with smaller ranges: ``rank`` is the rank
    wanted, ``below`` the values under ``low``, ``width`` the distinct values in the range."""
    cut = F.percentile_approx("x", [i / (SPLITTERS + 1) for i in range(1, SPLITTERS + 1)], _ACCURACY)
    inside = counts.join(targets, g).where(F.col("x").between(F.col("low"), F.col("high")))
    cuts = materialize(inside.groupBy(*g, "rank").agg(F.array_distinct(cut).alias("cuts")), "quantile-cuts")
    # intervals of the form cuts[i-1] < x <= cuts[i], numbered by the cuts that are smaller
    placed = inside.join(cuts, [*g, "rank"]).withColumn(
        "part", F.size(F.filter("cuts", lambda c: c < F.col("x"))))
    hist = placed.groupBy(*g, "rank", "part", "below").agg(
        F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("width"))
    order = Window.partitionBy(*g, "rank").orderBy("part")      # at most 64 rows each
    hist = hist.withColumn("upto", F.col("below") + F.sum("n").over(order))
    hold = hist.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    return materialize(hold.select(*g, "rank", "low", "high", (F.col("upto") - F.col("n")).alias("below"), "width"),
                       "quantile-ranges")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    window: int = WINDOW) -> DataFrame:
    """``by`` and, for each column of ``cols``, an array with its quantiles ``probs`` (null where
    the group has no value in the column). A group whose key has a null is a group."""
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    keys = [f"__k{i}" for i in range(len(by))]
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)]))
    # groups are numbered by their value, so that a null key joins like any other
    long = (df.select(F.struct(*[F.col(b).alias(k) for b, k in zip(by, keys)]) if by else F.lit(0), entry)
            .toDF("grp", "e").select("grp", "e.c", "e.x"))
    long = long.select(F.to_json("grp", {"ignoreNullFields": "false"}).alias("g") if by else F.lit("").alias("g"),
                       "grp", "c", "x")
    counts = materialize(long.groupBy("g", "c", "x").agg(F.count("*").alias("n"), F.first("grp").alias("grp")),
                         "value-counts")
    nan = F.isnan("x")
    groups = counts.groupBy("g").agg(F.first("grp").alias("grp"))
    sizes = counts.where("x is not null").groupBy("g", "c").agg(
        F.sum("n").alias("total"), F.sum(F.when(~nan, F.col("n")).otherwise(0)).alias("valid"),
        F.sum((~nan).cast("long")).alias("width"), F.min(F.when(~nan, F.col("x"))).alias("low"),
        F.max(F.when(~nan, F.col("x"))).alias("high"))
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.lit(p).alias("share")) for i, p in enumerate(probs)]))
    wanted = sizes.select("*", at.alias("a")).select("*", "a.p", ((F.col("total") - 1) * F.col("a.share")).alias("pos"))
    wanted = wanted.select("g", "c", "p", "pos", "total", "valid", "width", "low", "high",
                           F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))).alias("rank"))
    wanted = materialize(wanted, "quantile-wanted")
    values = counts.where(F.col("x").isNotNull() & ~nan).select("g", "c", "x", "n")
    key = ["g", "c"]
    targets = wanted.where("rank < valid").select(*key, "rank", "low", "high", F.lit(0).cast("long").alias("below"),
                                                  "width").distinct()
    targets = materialize(targets, "quantile-ranges")
    found = []
    while True:
        ready = targets.where((F.col("width") <= window) | (F.col("low") == F.col("high")))
        found.append(ready)
        wide = targets.where((F.col("width") > window) & (F.col("low") < F.col("high")))
        if wide.isEmpty():
            break
        targets = _narrowed(values, wide, key)
    ready = found[0]
    for more in found[1:]:
        ready = ready.union(more)
    inside = values.join(ready, key).where(F.col("x").between(F.col("low"), F.col("high")))
    order = Window.partitionBy(*key, "rank").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("upto", F.col("below") + F.sum("n").over(order))
    hit = ranked.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    hit = hit.select(*key, "rank", "x")
    both = (wanted.join(hit, [*key, "rank"], "left")
            .withColumn("x", F.when(F.col("rank") >= F.col("valid"), F.lit(float("nan"))).otherwise(F.col("x")))
            .groupBy(*key, "p", "pos").agg(F.min(F.struct("rank", "x")).alias("a"), F.max(F.struct("rank", "x")).alias("b")))
    low, high = F.floor("pos"), F.ceil("pos")
    value = F.when((low == high) | (F.col("a.x") == F.col("b.x")), F.col("a.x")).otherwise(
        (high - F.col("pos")) * F.col("a.x") + (F.col("pos") - low) * F.col("b.x"))
    rows = both.select(*key, "p", value.alias("q"))
    per = rows.groupBy("g").agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == i, F.struct("p", "q")))), lambda s: s.q).alias(f"__q{i}")
        for i in range(len(cols))])
    out = groups.join(per, "g", "left")
    return out.select(*[F.col("grp")[k].alias(b) for b, k in zip(by, keys)],
                      *[F.when(F.size(f"__q{i}") > 0, F.col(f"__q{i}")).alias(c) for i, c in enumerate(cols)])

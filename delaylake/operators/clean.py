"""Deduplication and imputation.

Global statistics are one-row aggregates joined back with a broadcast (a
proven one-row bound), so the whole operator stays one lazy plan with no
driver round trip. Group statistics are aggregates joined back on the group
key rather than windows: the aggregate is partial map-side and the join is
skew-split by AQE, whereas ``avg().over(partitionBy(key))`` would put every
row of a hub airport into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.operators.quantiles import exact_quantiles
from delaylake.session import materialize


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop full-row duplicates (or duplicates on ``subset``).

    A hash aggregate with a map-side partial step: a row copied a billion
    times is collapsed inside each task before anything is shuffled.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast the columns to double; NaN becomes null (pandas treats NaN as missing)."""
    cols = set(cols)
    out = []
    for name, typ in df.dtypes:
        if name in cols:
            c = F.col(name).cast("double")
            out.append(F.when(F.isnan(c), F.lit(None)).otherwise(c).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def mean_expr(c: str) -> F.Column:
    """sum / count with the sum kept in the column's own type.

    For DECIMAL readings the sum is exact, so the mean is the same double on
    any partitioning (and in DuckDB); NaN counts as missing.
    """
    x = F.when(F.isnan(F.col(c).cast("double")), F.lit(None)).otherwise(F.col(c))
    return F.try_divide(F.sum(x).cast("double"), F.count(x))


def _fill_from_one_row(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """coalesce(col, stat) with the one-row ``stats`` broadcast to every task."""
    s = stats.select(*[F.col(c).alias(f"__s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(s))
    return j.select(*[F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def impute_global_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null -> mean of the non-null values of the same column, over ``df``.

    The mean is taken over the rows as given (after the weather join it is
    flight-weighted, as in the reference). A column with no value stays null.
    """
    cols = list(cols)
    means = df.agg(*[mean_expr(c).alias(c) for c in cols])
    return _fill_from_one_row(as_double(df, cols), means, cols)


def impute_group_mean(df: DataFrame, cols: Sequence[str], by: str = "Dep_Airport") -> DataFrame:
    """Null -> mean of the same column within the row's ``by`` group."""
    cols = list(cols)
    g = df.groupBy(F.col(by).alias("__gk")).agg(*[mean_expr(c).alias(f"__g_{c}") for c in cols])
    g = materialize(g, "group-means")     # its size is then known: broadcast if small
    d = as_double(df, cols)
    # Plain equality: rows with a null key get no group value (pandas groupby
    # drops null keys), the global fallback fills them.
    j = d.join(g, d[by] == g["__gk"], "left")
    return j.select(*[F.coalesce(F.col(c), F.col(f"__g_{c}")).alias(c) if c in cols else F.col(c)
                      for c in d.columns])


def impute_global_median(df: DataFrame, cols: Sequence[str], exact: bool | str = True) -> DataFrame:
    """Null -> global median (linear interpolation) of the column.

    Spark's exact ``median`` keeps a value -> count map per partial aggregate,
    so memory follows the number of distinct values, not rows; for continuous
    high-cardinality columns pass ``exact="ranges"`` (the same medians by
    narrowing ranges, ``operators.quantiles``) or ``exact=False``
    (``percentile_approx``, a fixed-size sketch per task).
    """
    cols = list(cols)
    d = as_double(df, cols)
    if exact == "ranges":
        q = exact_quantiles(d, cols, [0.5])
        return _fill_from_one_row(d, df.sparkSession.range(1).join(q, F.lit(True), "left").select(
            *[F.col(f"`{c}`")[0].alias(c) for c in cols]), cols)
    meds = d.agg(*[(F.median(c) if exact else F.percentile_approx(c, 0.5, 100000)).alias(c)
                   for c in cols])
    return _fill_from_one_row(d, meds, cols)


def impute_group_then_median(df: DataFrame, cols: Sequence[str],
                             by: str = "Dep_Airport") -> DataFrame:
    """Group mean first; the remaining nulls (groups with no value) get the
    global median of the group-filled column."""
    return impute_global_median(impute_group_mean(df, cols, by), cols)

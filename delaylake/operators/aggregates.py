"""Lookup tables and summary aggregates.

All are ``groupBy().agg()`` with map-side partial aggregation. Exact median,
percentile and mode keep a value -> count map per group, so their memory
follows the distinct values of a group (minutes, durations, categories), never
its row count: a route with a third of all flights costs no more than any
other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators.quantiles import exact_quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def delay_rate(df: DataFrame, by: str = "Dep_Airport", label: str = "delay_label",
               alias: str = "dep_airport_delay_avg") -> DataFrame:
    return df.groupBy(by).agg(F.avg(label).alias(alias))


def weather_monthly_avg(weather: DataFrame, airport: str = "airport_id",
                        time: str = "time") -> DataFrame:
    """Mean of the four readings by (airport, month), rounded to 2 decimals
    (half-even). DECIMAL readings are averaged exactly before rounding.

    Groups with a null key are dropped, as a pandas groupby does.
    """
    w = weather.where(F.col(airport).isNotNull() & F.col(time).isNotNull())
    return (w.groupBy(F.col(airport).alias("airport_id"), F.month(time).alias("month"))
             .agg(*[F.bround(F.avg(F.col(c)), 2).cast("double").alias(c)
                    for c in K.WEATHER_COLS]))


def route_stats(f: DataFrame, exact: bool | str = True) -> DataFrame:
    """Median duration and modal haul type (smallest on a tie) per route.

    Null route keys are dropped (pandas groupby semantics). Durations are whole
    minutes, so the median's value map is small; ``exact="ranges"`` is for any
    number of distinct durations (see :func:`quantile_bounds`).
    """
    g = f.where(F.col("Dep_Airport").isNotNull() & F.col("Arr_Airport").isNotNull())
    if exact == "ranges":
        route = ["Dep_Airport", "Arr_Airport"]
        q = exact_quantiles(g, ["Flight_Duration"], [0.5], route)
        kind = g.groupBy(*route).agg(F.mode("Distance_type", True).alias("distance_type"))
        return q.select(*route, F.col("Flight_Duration")[0].alias("avg_duration")).join(kind, route)
    return (g.groupBy("Dep_Airport", "Arr_Airport")
             .agg(F.median("Flight_Duration").alias("avg_duration"),
                  F.mode("Distance_type", True).alias("distance_type")))


def median_age(f: DataFrame, col: str = "Aicraft_age", exact: bool | str = True) -> DataFrame:
    if exact == "ranges":
        return quantile_bounds(f, col, (0.5,), exact).select(F.col("q0").alias("median_age"))
    return f.agg(F.median(col).alias("median_age"))


def airports_distinct(df: DataFrame, col: str = "Dep_Airport") -> DataFrame:
    return df.select(F.col(col).alias("airport")).where(F.col("airport").isNotNull()) \
             .distinct().orderBy("airport")


def overall_stats(f: DataFrame) -> DataFrame:
    """Total flights, mean arrival delay, distinct airlines and airports."""
    return f.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.avg("Arr_Delay").alias("avg_delay"),
        F.count_distinct("Airline").alias("airlines"),
        F.count_distinct("Dep_Airport").alias("airports"),
    )


def quantile_bounds(df: DataFrame, col: str, qs: tuple[float, ...],
                    exact: bool | str = True, accuracy: int = 100000) -> DataFrame:
    """One row with the quantiles q0, q1, ...

    ``exact``: linear interpolation as pandas / DuckDB ``quantile_cont``; the
    aggregate keeps a value -> count map, so its size follows the column's
    distinct values (minutes, 2-decimal readings: small). For a continuous
    column with billions of distinct values pass ``exact="ranges"``: as exact, by
    narrowing ranges in fixed memory (``operators.quantiles``, a few jobs), or
    ``exact=False``: ``percentile_approx`` keeps a fixed-size sketch per task
    (relative rank error about 1 / ``accuracy``).
    """
    if exact == "ranges":
        q = exact_quantiles(df, [col], qs)
        one = df.sparkSession.range(1).join(q, F.lit(True), "left")      # a row also without values
        return one.select(*[F.col(f"`{col}`")[i].alias(f"q{i}") for i in range(len(qs))])
    arr = F.array(*[F.lit(q) for q in qs])
    agg = (F.percentile(F.col(col), arr) if exact
           else F.percentile_approx(F.col(col).cast("double"), arr, accuracy))
    return df.agg(agg.alias("__q")) \
             .select(*[F.col("__q")[i].cast("double").alias(f"q{i}") for i in range(len(qs))])


def winsorize_quantile(df: DataFrame, col: str, lo: float = K.WINSOR_Q[0],
                       hi: float = K.WINSOR_Q[1], out: str | None = None,
                       exact: bool | str = True) -> DataFrame:
    """Clip ``col`` to its own [q_lo, q_hi] (linear interpolation when exact).

    The one-row quantile table is broadcast; nulls stay null.
    """
    out = out or f"{col}_clip"
    b = quantile_bounds(df, col, (lo, hi), exact)
    j = df.crossJoin(F.broadcast(b))
    return j.select(*df.columns, C.clip(F.col(col), F.col("q0"), F.col("q1")).alias(out))


def quantile_filter(df: DataFrame, col: str, q: float = K.PRCP_Q,
                    exact: bool | str = True) -> DataFrame:
    """Keep rows with ``col`` <= its q-quantile."""
    b = quantile_bounds(df, col, (q,), exact)
    return df.crossJoin(F.broadcast(b)).where(F.col(col) <= F.col("q0")).select(*df.columns)

"""ETL: raw flight tables -> one clean, enriched flight table.

read -> (sample) -> cancel anti join -> dedup -> dates -> coords -> weather
-> global-mean weather fill -> constant fills -> calendar -> label -> target
rates. Nothing is collected. ``stage=False`` builds one lazy plan;
``stage=True`` (the production form) writes the joined rows once under the
shared checkpoint folder and takes every statistic from one grouping-sets pass
over them. Callers that fan out into many outputs (dashboard, training)
materialise the result once with :func:`materialize`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import clean, joins, projection, sampling
from delaylake.session import materialize


def _as_date(df: DataFrame, col: str) -> DataFrame:
    if dict(df.dtypes).get(col) == "date":
        return df
    return df.withColumn(col, C.to_date_lenient(col))


def etl_clean_enrich(flights: DataFrame, cancelled: DataFrame, airports: DataFrame,
                     weather: DataFrame, sample_frac: float | None = None,
                     sample_keys: Sequence[str] | None = None,
                     null_safe_cancel: bool = False,
                     rates_source: DataFrame | None = None, stage: bool = False) -> DataFrame:
    """The clean table. With ``stage`` the joined rows are written once under
    the shared checkpoint folder before the fills: the global means, the fill
    and the two rate aggregates then read column-pruned Parquet instead of each
    re-running the anti join, dedup and joins (four passes over the lineage
    otherwise)."""
    f = flights
    if sample_frac is not None and sample_frac < 1.0:
        f = sampling.sample_fraction(f, sample_frac, sample_keys or f.columns)
    # Duplicates go first: the anti join is then the last to shuffle on its keys
    # and adaptive execution may split a hot key (the result is the same).
    f = clean.dedup_rows(f)
    f = joins.cancel_anti_join(f, cancelled, null_safe=null_safe_cancel)
    f = _as_date(f, "FlightDate")
    w = _as_date(weather, "time")
    f = joins.join_airport_coords(f, airports)
    f = joins.join_daily_weather(f, w)
    if stage:
        return _finish_staged(materialize(f, "etl-joined"), rates_source)
    f = clean.impute_global_mean(f, K.WEATHER_COLS)
    f = projection.fill_constants(f, K.FILL_PHASE2)
    # day_of_week (Sunday = 1) replaces the source's ISO Day_Of_Week: the two
    # names collide under case-insensitive resolution, and the reference's
    # withColumn replaced it the same way.
    f = f.drop("Day_Of_Week").select(
        "*", F.year("FlightDate").alias("year"), F.month("FlightDate").alias("month"),
        F.dayofweek("FlightDate").alias("day_of_week"),
        C.delay_label("Arr_Delay").alias("delay_label"))
    return joins.join_target_rates(f, rates_source)


def _finish_staged(joined: DataFrame, rates_source: DataFrame | None) -> DataFrame:
    """Fills, label and target rates over the staged joined table, with every
    statistic from ONE grouping-sets aggregate: the global weather means (set
    ()), the departure rates (Dep_Airport) and the arrival rates (Arr_Airport).
    The big table is scanned once for statistics instead of three times; the
    statistics (1 + 2 x airports rows) are staged and broadcast back.
    """
    if rates_source is not None:          # rates from other rows: the composed path
        f = clean.impute_global_mean(joined, K.WEATHER_COLS)
        f = projection.fill_constants(f, K.FILL_PHASE2).drop("Day_Of_Week")
        f = f.select("*", F.year("FlightDate").alias("year"), F.month("FlightDate").alias("month"),
                     F.dayofweek("FlightDate").alias("day_of_week"),
                     C.delay_label("Arr_Delay").alias("delay_label"))
        return joins.join_target_rates(f, rates_source)
    label = C.delay_label("Arr_Delay")
    stats = (joined.groupingSets([[], ["Dep_Airport"], ["Arr_Airport"]], "Dep_Airport", "Arr_Airport")
                   .agg(*[clean.mean_expr(c).alias(f"__m_{c}") for c in K.WEATHER_COLS],
                        F.avg(label).alias("__rate"), F.grouping_id().alias("__gid")))
    stats = materialize(stats, "etl-stats")
    means = stats.where(F.col("__gid") == 3).select(*[f"__m_{c}" for c in K.WEATHER_COLS])
    dep = stats.where(F.col("__gid") == 1).select(
        F.col("Dep_Airport").alias("__dk"), F.col("__rate").alias("dep_airport_delay_avg"))
    arr = stats.where(F.col("__gid") == 2).select(
        F.col("Arr_Airport").alias("__ak"), F.col("__rate").alias("arr_airport_delay_avg"))
    d = clean.as_double(joined, K.WEATHER_COLS).crossJoin(F.broadcast(means))
    d = d.select(*[F.coalesce(F.col(c), F.col(f"__m_{c}")).alias(c) if c in K.WEATHER_COLS
                   else F.col(c) for c in joined.columns])
    d = projection.fill_constants(d, K.FILL_PHASE2).drop("Day_Of_Week")
    d = d.select("*", F.year("FlightDate").alias("year"), F.month("FlightDate").alias("month"),
                 F.dayofweek("FlightDate").alias("day_of_week"), label.alias("delay_label"))
    # one row per airport on each side: AQE broadcasts them after measuring
    d = d.join(dep, d["Dep_Airport"] == dep["__dk"], "left").drop("__dk")
    return d.join(arr, d["Arr_Airport"] == arr["__ak"], "left").drop("__ak")


def labelled_rows(flights: DataFrame, cancelled: DataFrame,
                  null_safe_cancel: bool = False) -> DataFrame:
    """The clean table's rows reduced to what the delay label needs.

    Every other ETL step is a left join to a dimension made unique on its key
    (coordinates, daily weather), a one-row fill of weather columns, or new
    columns: none adds, drops or repeats a row or touches ``Arr_Delay``. So
    per-airport delay rates computed here equal those over the full clean
    table, without the weather join, the mean pass or the coordinate join.
    """
    f = joins.cancel_anti_join(clean.dedup_rows(flights), cancelled, null_safe=null_safe_cancel)
    f = projection.fill_constants(f.select("Dep_Airport", "Arr_Airport", "Arr_Delay"),
                                  {"Arr_Delay": 0})
    return f.withColumn("delay_label", C.delay_label("Arr_Delay"))

"""The two other preprocessing chains, composed from the operators.

``stacked_features``: years stacked -> duplicates dropped -> null-safe anti join
-> coordinates and weather joined -> weather filled by airport mean, then median
-> median age -> label, calendar, weekend -> leakage dropped -> airports encoded
-> dummies -> zeros for what is still missing.

``phase1_rows``: anti join -> weather -> label -> constant fills -> the columns
that exist -> rows with a missing value dropped -> hash sample -> dummies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import clean, features, joins, projection, sampling
from delaylake.session import materialize

STACKED_BASE = ["Dep_Airport_Encoded", "Arr_Airport_Encoded", "Day_Of_Week", "Flight_Duration",
                "Aicraft_age", "tavg", "prcp", "wspd", "pres", "month", "day", "is_weekend",
                "LATITUDE", "LONGITUDE"]
PHASE1_COLS = ["Airline", "DepTime_label", "Flight_Duration", "Distance_type", "Aicraft_age",
               "tavg", "prcp", "wspd", "is_delayed"]


def stacked_features(years: Sequence[DataFrame], cancelled: DataFrame, airports: DataFrame,
                     weather: DataFrame, cats: dict[str, list[str]],
                     keys: Sequence[str] = ()) -> DataFrame:
    """Feature table of all years (``keys`` are carried along); ``cats`` lists
    the categories of the dummy columns, the first of each left out."""
    f = clean.dedup_rows(sampling.union_parts(*years))
    f = joins.cancel_anti_join(f, cancelled, null_safe=True)
    f = joins.join_airport_coords(f, airports)
    f = joins.join_daily_weather(f, weather)
    # Written once: means, medians and codes each read it, not the joins.
    f = materialize(f, "stacked-joined")
    f = clean.impute_group_then_median(f, K.WEATHER_COLS)
    f = clean.impute_global_median(f, ["Aicraft_age"])
    f = f.withColumn("is_delayed", C.delay_label("Arr_Delay"))
    f = projection.add_weekend_flag(f).select("*", F.month("FlightDate").alias("month"),
                                              F.dayofmonth("FlightDate").alias("day"))
    f = projection.drop_leakage(f)
    f = features.label_encode(f).transform(f)
    f = features.dummy_columns(f, list(cats), cats, drop_first=True)
    hot = projection.prefix_columns(f, [c + "_" for c in cats])
    return f.select(*keys, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c)
                             for c in STACKED_BASE], *[F.col(f"`{c}`") for c in hot], "is_delayed")


def phase1_rows(flights: DataFrame, cancelled: DataFrame, weather: DataFrame,
                keys: Sequence[str], cats: dict[str, list[str]], frac: float = 0.05) -> DataFrame:
    """Sampled training rows of the first phase, with dummies."""
    f = joins.cancel_anti_join(flights, cancelled)
    f = joins.join_daily_weather(f, weather)
    f = f.withColumn("is_delayed", C.delay_label("Arr_Delay"))
    f = projection.fill_constants(clean.as_double(f, K.WEATHER_COLS), K.FILL_PHASE1)
    f = projection.drop_missing(projection.select_available(f, [*keys, *PHASE1_COLS]))
    f = sampling.sample_fraction(f, frac, list(keys))
    return features.dummy_columns(f, list(cats), cats, drop_first=True)

"""Training sets and the end-to-end training job.

Classifier rows are the clean ETL table; regressor rows follow the
delay-minutes recipe (balanced sample of clipped delays, coords and weather
joined, medians filled). Both are lazy DataFrames; :func:`train_all`
materialises the clean table once under the shared checkpoint folder before
fanning out to several fits, so each fit reads Parquet instead of
recomputing the join lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import clean, joins, models, sampling
from delaylake.operators.projection import fill_constants


def regression_frame(flights: DataFrame, weather: DataFrame, airports: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    d = sampling.balanced_sample(flights, keys)
    d = joins.join_airport_coords(d, airports)
    d = joins.join_daily_weather(d, weather)
    d = d.select("*", F.month("FlightDate").alias("month"), F.dayofmonth("FlightDate").alias("day"),
                 C.weekend_flag("Day_Of_Week").alias("is_weekend"))
    d = clean.impute_global_median(d, K.WEATHER_COLS + ["Flight_Duration"])
    d = fill_constants(d, K.FILL_REGRESSOR)
    return d.withColumnRenamed("Day_Of_Week", "dow_iso")


def train_all(clean_table: DataFrame, flights: DataFrame, weather: DataFrame,
              airports: DataFrame, keys: Sequence[str], out_dir: str | None = None,
              gbt_iter: int = 20, gbt_depth: int = 5, reg_iter: int = 100) -> dict:
    """Fit the GBT classifier and the regressor; optionally save both."""
    train, test = sampling.split_train_test(clean_table, keys)
    clf = models.gbt_classifier(train, max_iter=gbt_iter, max_depth=gbt_depth)
    reg_rows = regression_frame(flights, weather, airports, keys)
    rtrain, rtest = sampling.split_train_test(reg_rows, keys)
    reg = models.gbt_regressor(rtrain, max_iter=reg_iter)
    if out_dir:
        models.save_model(clf, f"{out_dir.rstrip('/')}/gbt_classifier")
        models.save_model(reg, f"{out_dir.rstrip('/')}/gbt_regressor")
    return {"classifier": clf, "regressor": reg, "test": test, "reg_test": rtest}

"""The dashboard kept as a state of mergeable partials, so that a new day is added, not recomputed.

A batch of clean rows (a day, a month, a late file) leaves three small tables: sums, counts
and minima for each of the dashboard's groups; counts of the delays in each temperature band;
and the rows that the scatter sample may need, the first by hash. Sums add, counts add, minima
and first-n lists merge, distinct airlines and airports are the groups' own keys, and quantiles
and medians are taken from the added counts: the payload of the merged state is that of a
rebuild, for any split of the rows into batches.

Each batch is a published folder (``sources.publish``) below the state's path: adding a batch
again replaces it, and a reader sees a batch as a whole or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import dashboard as D
from delaylake.plans import dashboard as DB
from delaylake.sources.publish import children, current
from delaylake.sources.tables import publish_lookups


def partials(clean: DataFrame, keys: Sequence[str], n: int = K.SAMPLE_POINTS) -> dict[str, DataFrame]:
    """The mergeable tables of some rows: groups, delays, sample."""
    groups = DB.grouped(clean, list(DB.GROUP_SETS), [
        F.count(F.lit(1)).alias("n_rows"), F.count("Arr_Delay").alias("n"),
        F.sum("Arr_Delay").alias("total"),          # whole minutes: a long, exact in any order
        F.sum(F.col("delay_label").cast("long")).alias("n_delayed"), F.min("FlightDate").alias("first_date")])
    points = D.temp_points(clean, keys=keys)
    delays = (points.groupBy(C.temp_band("temperature_c").alias("temp_band"), "arrival_delay")
              .agg(F.count("*").alias("n")))
    return {"groups": groups, "delays": delays, "sample": D.sample_points(points, keys, n)}


def add_batch(spark: SparkSession, path: str, batch: str, clean: DataFrame, keys: Sequence[str]) -> None:
    """Adds (or replaces) the partials of one batch of rows."""
    publish_lookups(partials(clean, keys), f"{path.rstrip('/')}/{batch}")


def _all(spark: SparkSession, path: str, name: str) -> DataFrame:
    path = path.rstrip("/")
    found = [current(spark, f"{path}/{b}") for b in children(spark, path)]
    folders = [f"{f}/{name}" for f in found if f is not None]
    if not folders:
        raise FileNotFoundError(f"no state at {path}")
    return spark.read.parquet(*folders)


def merged(spark: SparkSession, path: str, keys: Sequence[str], n: int = K.SAMPLE_POINTS) -> dict[str, DataFrame]:
    """The partials of all batches as those of one."""
    groups = _all(spark, path, "groups").groupBy("gset", *DB.GROUP_KEYS).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.sum("n_delayed").alias("n_delayed"), F.min("first_date").alias("first_date"))
    delays = _all(spark, path, "delays").groupBy("temp_band", "arrival_delay").agg(F.sum("n").alias("n"))
    return {"groups": groups.withColumn("avg_delay", F.try_divide(F.col("total").cast("double"), F.col("n"))),
            "delays": delays, "sample": D.sample_points(_all(spark, path, "sample"), keys, n)}


def overall_stats(groups: DataFrame) -> DataFrame:
    """Total flights, mean arrival delay, distinct airlines and airports of the merged groups."""
    one = lambda c, name: F.max(F.when(F.col("gset") == name, F.col(c)))
    known = lambda c, name: F.count_if((F.col("gset") == name) & F.col(c).isNotNull())
    return groups.agg(F.coalesce(one("n_rows", "all"), F.lit(0)).alias("total_flights"),
                      one("avg_delay", "all").alias("avg_delay"), known("Airline", "airline").alias("airlines"),
                      known("Dep_Airport", "airport").alias("airports"))


def dashboard_from_state(spark: SparkSession, path: str, airports: DataFrame, keys: Sequence[str]
                         ) -> dict[str, DataFrame]:
    """Every dashboard table (as ``plans.dashboard.dashboard_tables``) and ``overall``."""
    state = merged(spark, path, keys)
    out = DB.tables_from_groups(state["groups"], airports)
    bounds = state["delays"].agg(F.percentile("arrival_delay", F.array(*map(F.lit, K.WINSOR_Q)), F.col("n")).alias("q"))
    clipped = state["delays"].crossJoin(F.broadcast(bounds)).withColumn(
        "clip", C.clip("arrival_delay", F.col("q")[0], F.col("q")[1]))
    out["temperature_trend"] = (clipped.groupBy("temp_band").agg(
        (F.sum(F.col("clip") * F.col("n")) / F.sum("n")).alias("avg_delay"),
        F.percentile("clip", F.lit(0.5), F.col("n")).alias("median_delay"), F.sum("n").alias("flight_count"))
        .where(F.col("flight_count") >= K.TEMP_MIN_COUNT).orderBy("temp_band"))
    out["temperature_sample"] = state["sample"].crossJoin(F.broadcast(bounds)).select(
        *keys, "temperature_c", C.clip("arrival_delay", F.col("q")[0], F.col("q")[1]).alias("arrival_delay"))
    out["overall"] = overall_stats(state["groups"])
    return out

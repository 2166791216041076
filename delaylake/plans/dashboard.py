"""All dashboard tables from one clean flight table.

Five of the tables (monthly mean and count, airline ranking, airport map,
day x slot heatmap, precipitation scatter) are grouped means over the same
rows under different keys. They are computed in ONE pass with grouping sets:
an Expand feeds a single partial + final aggregate, so the big table is
scanned once and only per-task partial aggregates are shuffled. The grouped
result is small (months + airlines + airports + 28 cells + distinct
precipitation values); it is written once under the shared checkpoint folder
and the five tables are cheap projections of it.

The temperature trend/sample and the precipitation trend need quantile bounds
first, so they keep their own passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import dashboard as D
from delaylake.plans.etl import materialize
from delaylake.plans.fixtures import slot_label

GROUP_KEYS = ["month_num", "Airline", "Dep_Airport", "day_of_week", "slot", "prcp_v"]
# The named grouping sets; "all" is the whole table.
GROUP_SETS = {"month": ["month_num"], "airline": ["Airline"], "airport": ["Dep_Airport"],
              "heat": ["day_of_week", "slot"], "prcp": ["prcp_v"], "all": []}


def grouped(clean: DataFrame, sets: Sequence[str], aggs: Sequence[F.Column],
            slot: F.Column | None = None) -> DataFrame:
    """One aggregate for several grouping sets of GROUP_SETS; ``gset`` names the set."""
    slot = slot_label() if slot is None else slot
    f = clean.select(F.month("FlightDate").alias("month_num"), "Airline", "Dep_Airport",
                     F.dayofweek("FlightDate").alias("day_of_week"), slot.alias("slot"),
                     F.col("prcp").alias("prcp_v"), "Arr_Delay", "delay_label", "FlightDate")
    g = f.groupingSets([GROUP_SETS[s] for s in sets], *GROUP_KEYS).agg(*aggs, F.grouping_id().alias("gid"))
    gset = F.lit(None).cast("string")
    for name in sets:
        # grouping_id has a bit for each column that is aggregated away, the first one highest
        gid = sum(1 << (len(GROUP_KEYS) - 1 - i) for i, k in enumerate(GROUP_KEYS) if k not in GROUP_SETS[name])
        gset = F.when(F.col("gid") == gid, F.lit(name)).otherwise(gset)
    return g.withColumn("gset", gset).drop("gid")


def grouped_means(clean: DataFrame, slot: F.Column | None = None) -> DataFrame:
    """One aggregate for all plain grouped means."""
    return grouped(clean, ["month", "airline", "airport", "heat", "prcp"],
                   [F.avg("Arr_Delay").alias("avg_delay"), F.sum(F.col("delay_label").cast("long")).alias("n_delayed"),
                    F.min("FlightDate").alias("first_date")], slot)


def _r2(c):
    return F.bround(c, 2)


def tables_from_groups(g: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    months = F.element_at(F.array(*[F.lit(m) for m in K.MONTH_ABBR]), F.col("month_num"))
    m = g.where(F.col("gset") == "month")
    monthly = m.select("month_num", months.alias("Month"),
                       _r2("avg_delay").alias("Average_Arrival_Delay_Minutes")).orderBy("month_num")
    counts = m.select("month_num", months.alias("Month"),
                      F.col("n_delayed").alias("Total_Delays")).orderBy("month_num")
    ranking = (g.where(F.col("gset") == "airline")
                .select("Airline", _r2("avg_delay").alias("Average_Arrival_Delay"))
                .orderBy(F.desc("Average_Arrival_Delay"), "Airline"))
    per_airport = g.where(F.col("gset") == "airport").select(
        "Dep_Airport", _r2("avg_delay").alias("__avg"))
    a = airports.select(F.col("IATA_CODE").alias("Dep_Airport"), "LATITUDE", "LONGITUDE")
    avg_c = F.coalesce(F.col("__avg"), F.lit(0.0))
    disp = C.clip(avg_c, *K.MAP_DISPLAY_CLIP)
    airport_map = a.join(per_airport, "Dep_Airport", "left").select(
        "Dep_Airport", "LATITUDE", "LONGITUDE", avg_c.alias("Average_Delay"),
        disp.alias("Average_Delay_Display"), C.bubble_size(disp).alias("Bubble_Size"))
    heat = (g.where((F.col("gset") == "heat") & F.col("slot").isNotNull())
             .select("day_of_week", F.col("slot").alias("DepTime_label"),
                     _r2("avg_delay").alias("Average_Delay"),
                     F.date_format("first_date", "EEE").alias("Day"))
             .withColumn("Delay_Level", C.delay_level("Average_Delay")))
    scatter = (g.where((F.col("gset") == "prcp") & F.col("prcp_v").isNotNull())
                .select(F.col("prcp_v").cast("double").alias("prcp"),
                        _r2("avg_delay").alias("Average_Delay")))
    return {
        "monthly_delay": monthly, "monthly_delay_count": counts, "top_airlines": ranking,
        "airport_map": airport_map, "delay_heatmap": heat, "heatmap_matrix": D.heatmap_pivot(heat),
        "precipitation_scatter": scatter, "precipitation_trend": D.rain_delay_trend(scatter),
        "summary": D.summary_peaks(monthly, ranking, counts),
    }


def dashboard_tables(clean: DataFrame, airports: DataFrame,
                     keys: Sequence[str], stage: bool = True) -> dict[str, DataFrame]:
    """Every dashboard table. ``clean`` should already be materialised."""
    g = grouped_means(clean)
    if stage:
        g = materialize(g, "dashboard-groups")
    out = tables_from_groups(g, airports)
    out["temperature_trend"] = D.temp_delay_trend(clean)
    out["temperature_sample"] = D.temp_delay_sample(clean, list(keys))
    return out


def payload(tables: dict[str, DataFrame]) -> DataFrame:
    """All sections as one table of (section, record JSON), like the payload
    document the dashboard serves. Each record keeps its sort key (month,
    band, day position), so order survives the union."""
    parts = [df.select(F.lit(name).alias("section"),
                       F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"))
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def write_dashboard(clean: DataFrame, airports: DataFrame, keys: Sequence[str], path: str) -> None:
    """Every section in one write: one job instead of one per section."""
    payload(dashboard_tables(clean, airports, keys)).write.mode("overwrite").parquet(path)

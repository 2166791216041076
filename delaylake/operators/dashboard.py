"""Dashboard tables, computed from the clean flight table.

Input columns used: FlightDate, Airline, Dep_Airport, DepTime_label,
Arr_Delay, tavg, prcp, delay_label (and a row key for the scatter sample).
Every table is a grouped aggregate over the whole input; quantile bounds are
one-row aggregates broadcast back; the only ``limit`` calls are the features
themselves (the 2,000-point sample and the one-row peaks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators.aggregates import quantile_bounds, quantile_filter


def _r2(c) -> F.Column:
    return F.bround(c, 2)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _number(df: DataFrame, col: str) -> F.Column:
    """The column as a double; text is parsed leniently (bad text -> null)."""
    t = dict(df.dtypes)[col]
    if t in _NUMERIC or t.startswith("decimal"):
        return F.col(col).cast("double")
    return C.to_number_lenient(F.col(col))


def temp_points(f: DataFrame, temp: str = "tavg", delay: str = "Arr_Delay",
                keys: Sequence[str] = ()) -> DataFrame:
    """(temperature_c, arrival_delay) for valid readings: both values coerced to
    numbers, rows with a missing one dropped, the temperature kept in [-35, 45]."""
    t = f.select(*keys, _number(f, temp).alias("temperature_c"),
                 _number(f, delay).alias("arrival_delay"))
    t = t.where(F.col("temperature_c").isNotNull() & ~F.isnan("temperature_c")
                & F.col("arrival_delay").isNotNull() & ~F.isnan("arrival_delay"))
    return t.where(F.col("temperature_c").between(*K.TEMP_RANGE))


def temp_delay_points(f: DataFrame, temp: str = "tavg", delay: str = "Arr_Delay",
                      keys: Sequence[str] = ()) -> DataFrame:
    """(temperature_c, arrival_delay, arrival_delay_clip): the valid readings, the
    delay clipped at its own 2 % / 98 % quantiles."""
    t = temp_points(f, temp, delay, keys)
    b = quantile_bounds(t, "arrival_delay", K.WINSOR_Q)
    return (t.crossJoin(F.broadcast(b))
             .select(*keys, "temperature_c", "arrival_delay",
                     C.clip("arrival_delay", F.col("q0"), F.col("q1")).alias("arrival_delay_clip")))


def temp_delay_trend(f: DataFrame, min_count: int = K.TEMP_MIN_COUNT) -> DataFrame:
    """Per 2-degree band: mean and median clipped delay, raw count; bands with
    fewer than ``min_count`` flights dropped; ordered by band."""
    p = temp_delay_points(f)
    return (p.groupBy(C.temp_band("temperature_c").alias("temp_band"))
             .agg(F.avg("arrival_delay_clip").alias("avg_delay"),
                  F.median("arrival_delay_clip").alias("median_delay"),
                  F.count(F.lit(1)).alias("flight_count"))
             .where(F.col("flight_count") >= min_count)
             .orderBy("temp_band"))


def sample_points(points: DataFrame, keys: Sequence[str], n: int = K.SAMPLE_POINTS,
                  seed: int = K.SEED) -> DataFrame:
    """Up to ``n`` points, chosen by a stable hash of the row key.

    A top-n by hash: each task keeps its n smallest, so only n rows per task
    move; the choice does not depend on partitioning.
    """
    h = F.md5(C.hash_key(list(keys), seed))
    return points.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")


def temp_delay_sample(f: DataFrame, keys: Sequence[str], n: int = K.SAMPLE_POINTS) -> DataFrame:
    p = temp_delay_points(f, keys=keys)
    return sample_points(p, keys, n).select(
        *keys, "temperature_c", F.col("arrival_delay_clip").alias("arrival_delay"))


def rain_delay_scatter(f: DataFrame, prcp: str = "prcp", delay: str = "Arr_Delay") -> DataFrame:
    """Mean arrival delay per distinct precipitation value, 2 decimals."""
    return (f.where(F.col(prcp).isNotNull())
             .groupBy(F.col(prcp).alias("__p"))
             .agg(_r2(F.avg(delay)).alias("Average_Delay"))
             .select(F.col("__p").cast("double").alias("prcp"), "Average_Delay"))


def rain_delay_trend(scatter: DataFrame) -> DataFrame:
    """From the scatter table: keep prcp <= its 99 % quantile, clip the delay at
    its 2 % / 98 % quantiles, then mean and count per 2 mm band."""
    s = scatter.select(_number(scatter, "prcp").alias("prcp"),
                       _number(scatter, "Average_Delay").alias("Average_Delay"))
    s = s.where(F.col("prcp").isNotNull() & F.col("Average_Delay").isNotNull())
    s = quantile_filter(s, "prcp", K.PRCP_Q)
    b = quantile_bounds(s, "Average_Delay", K.WINSOR_Q)
    s = s.crossJoin(F.broadcast(b)).select(
        "prcp", C.clip("Average_Delay", F.col("q0"), F.col("q1")).alias("delay_clip"))
    return (s.groupBy(C.rain_band("prcp").alias("rain_band"))
             .agg(F.avg("delay_clip").alias("avg_delay"),
                  F.count(F.lit(1)).alias("point_count"))
             .orderBy("rain_band"))


def airport_delay_map(f: DataFrame, airports: DataFrame) -> DataFrame:
    """Every airport with coordinates, its mean arrival delay (0 when it has
    none), the display value clipped to [-15, 45] and the bubble size."""
    avg = f.groupBy("Dep_Airport").agg(_r2(F.avg("Arr_Delay")).alias("__avg"))
    a = airports.select(F.col("IATA_CODE").alias("Dep_Airport"), "LATITUDE", "LONGITUDE")
    j = a.join(avg, "Dep_Airport", "left")
    avg_c = F.coalesce(F.col("__avg"), F.lit(0.0))
    disp = C.clip(avg_c, *K.MAP_DISPLAY_CLIP)
    return j.select("Dep_Airport", "LATITUDE", "LONGITUDE", avg_c.alias("Average_Delay"),
                    disp.alias("Average_Delay_Display"), C.bubble_size(disp).alias("Bubble_Size"))


def delay_heatmap(f: DataFrame, slots: Sequence[str] = tuple(K.TIME_ORDER)) -> DataFrame:
    """Mean arrival delay by (day of week, departure slot); Sunday = 1.

    Rows whose slot is not one of ``slots`` are left out."""
    g = (f.where(F.col("DepTime_label").isin(*slots))
          .groupBy(F.dayofweek("FlightDate").alias("day_of_week"), "DepTime_label")
          .agg(_r2(F.avg("Arr_Delay")).alias("Average_Delay"),
               F.min("FlightDate").alias("__d")))
    return g.select("day_of_week", "DepTime_label", "Average_Delay",
                    F.date_format("__d", "EEE").alias("Day"),
                    C.delay_level("Average_Delay").alias("Delay_Level"))


def heatmap_pivot(heatmap: DataFrame) -> DataFrame:
    """Day x slot matrix in fixed order both ways; absent cells are 0.

    The pivot values are listed, so no job runs to discover them. The day list
    is a 7-row literal joined on the right, so absent days appear as zeros.
    """
    spark = heatmap.sparkSession
    p = (heatmap.groupBy("Day")
                .pivot("DepTime_label", list(K.TIME_ORDER))
                .agg(F.max("Average_Delay")))
    days = spark.createDataFrame([(i + 1, d) for i, d in enumerate(K.DAY_ORDER)],
                                 "day_pos int, Day string")
    j = days.join(p, "Day", "left")
    return (j.select("day_pos", "Day",
                     *[_r2(F.coalesce(F.col(t), F.lit(0.0))).alias(t) for t in K.TIME_ORDER])
             .orderBy("day_pos"))


def _month_name(m) -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in K.MONTH_ABBR]), m)


def monthly_avg_delay(f: DataFrame) -> DataFrame:
    g = f.groupBy(F.month("FlightDate").alias("month_num")).agg(
        _r2(F.avg("Arr_Delay")).alias("Average_Arrival_Delay_Minutes"))
    return g.select("month_num", _month_name(F.col("month_num")).alias("Month"),
                    "Average_Arrival_Delay_Minutes").orderBy("month_num")


def monthly_delay_count(f: DataFrame, label: str = "delay_label") -> DataFrame:
    g = f.groupBy(F.month("FlightDate").alias("month_num")).agg(
        F.sum(F.col(label).cast("long")).alias("Total_Delays"))
    return g.select("month_num", _month_name(F.col("month_num")).alias("Month"),
                    "Total_Delays").orderBy("month_num")


def airline_ranking(f: DataFrame) -> DataFrame:
    return (f.groupBy("Airline").agg(_r2(F.avg("Arr_Delay")).alias("Average_Arrival_Delay"))
             .orderBy(F.desc("Average_Arrival_Delay"), "Airline"))


def summary_peaks(monthly_avg: DataFrame, ranking: DataFrame, monthly_count: DataFrame) -> DataFrame:
    """Three rows: peak month by mean delay, top airline, month with most
    delays. Ties go to the earlier month / the alphabetically first airline."""
    a = (monthly_avg.orderBy(F.desc("Average_Arrival_Delay_Minutes"), "month_num").limit(1)
                    .select(F.lit("peak_month").alias("metric"), F.col("Month").alias("label"),
                            _r2(F.col("Average_Arrival_Delay_Minutes")).cast("double")
                            .alias("value")))
    b = (ranking.orderBy(F.desc("Average_Arrival_Delay"), "Airline").limit(1)
                .select(F.lit("top_airline").alias("metric"), F.col("Airline").alias("label"),
                        _r2(F.col("Average_Arrival_Delay")).cast("double").alias("value")))
    c = (monthly_count.orderBy(F.desc("Total_Delays"), "month_num").limit(1)
                      .select(F.lit("delay_volume_peak").alias("metric"),
                              F.col("Month").alias("label"),
                              F.col("Total_Delays").cast("double").alias("value")))
    return a.unionByName(b).unionByName(c)


from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from delaylake.functions import constants as K
from delaylake.operators import dashboard as D
from delaylake.plans import fixtures as X
from delaylake.plans.oracle import round_even as RE
from delaylake.plans.oracle import with_views as W
from delaylake.plans.registry import query
from delaylake.sources.views import FLIGHT_KEY

KEY = list(FLIGHT_KEY)
KS = ", ".join(KEY)


def r6(c):
    return F.round(c, 6)


# ---- shared SQL fragments ---------------------------------------------------------

_T_POINTS = """
SELECT {keys}tavg AS temperature_c, CAST(Arr_Delay AS DOUBLE) AS arrival_delay FROM clean
WHERE tavg IS NOT NULL AND NOT isnan(tavg) AND Arr_Delay IS NOT NULL AND tavg BETWEEN -35 AND 45
"""
_T_CLIP = """
SELECT t.*, CASE WHEN arrival_delay IS NULL THEN NULL
                 ELSE least(greatest(arrival_delay, q.q[1]), q.q[2]) END AS arrival_delay_clip
FROM tpts t CROSS JOIN (SELECT quantile_cont(arrival_delay, [0.02, 0.98]) AS q FROM tpts) q
"""
_SCATTER = f"""
SELECT CAST(prcp AS DOUBLE) AS prcp, {RE("avg(Arr_Delay)", 2)} AS Average_Delay
FROM clean WHERE prcp IS NOT NULL GROUP BY prcp
"""
_RAIN_F = """
SELECT * FROM scatter WHERE prcp <= (SELECT quantile_cont(prcp, 0.99) FROM scatter)
"""
_RAIN_TREND = """
SELECT CAST(floor(prcp / 2) * 2 AS INTEGER) AS rain_band,
       avg(least(greatest(Average_Delay, q.q[1]), q.q[2])) AS avg_delay, count(*) AS point_count
FROM rainf CROSS JOIN (SELECT quantile_cont(Average_Delay, [0.02, 0.98]) AS q FROM rainf) q
GROUP BY 1
"""
_HEAT = f"""
SELECT CAST(dayofweek(FlightDate) + 1 AS INTEGER) AS day_of_week, {X.SLOT_SQL} AS DepTime_label,
       {RE("avg(Arr_Delay)", 2)} AS Average_Delay, strftime(min(FlightDate), '%a') AS Day
FROM clean WHERE {X.SLOT_SQL} IS NOT NULL GROUP BY 1, 2
"""
_HEATMAP = """
SELECT day_of_week, DepTime_label, Average_Delay, Day,
       CASE WHEN Average_Delay < 15 THEN 'Low' WHEN Average_Delay IS NOT NULL THEN 'Medium' END
         AS Delay_Level
FROM heat
"""
_MONTHLY = f"""
SELECT CAST(month(FlightDate) AS INTEGER) AS month_num,
       {RE("avg(Arr_Delay)", 2)} AS Average_Arrival_Delay_Minutes,
       CAST(sum(delay_label) AS BIGINT) AS Total_Delays
FROM clean GROUP BY 1
"""
_MONTHS = "[" + ", ".join(f"'{m}'" for m in K.MONTH_ABBR) + "]"
_RANKING = f"""
SELECT Airline, {RE("avg(Arr_Delay)", 2)} AS Average_Arrival_Delay FROM clean GROUP BY 1
"""


def _heat_input(spark, sf):
    c = X.clean(spark, sf)
    return c.withColumn("DepTime_label", X.slot_label())


# ---- queries ------------------------------------------------------------------------

@query("temp_delay_trend", W(f"""
SELECT CAST({RE("temperature_c / 2", 0)} * 2 AS INTEGER) AS temp_band,
       round(avg(arrival_delay_clip), 6) AS avg_delay,
       round(median(arrival_delay_clip), 6) AS median_delay, count(*) AS flight_count
FROM tclip GROUP BY 1 HAVING count(*) >= 40""",
                              ctes=(("tpts", _T_POINTS.format(keys="")), ("tclip", _T_CLIP))))
def q_temp_delay_trend(spark, sf):
    t = D.temp_delay_trend(X.clean(spark, sf))
    return t.select("temp_band", r6("avg_delay").alias("avg_delay"),
                    r6("median_delay").alias("median_delay"), "flight_count")


@query("sort_bands", W(f"""
SELECT temp_band, flight_count, row_number() OVER (ORDER BY temp_band) AS band_pos FROM (
  SELECT CAST({RE("temperature_c / 2", 0)} * 2 AS INTEGER) AS temp_band, count(*) AS flight_count
  FROM tclip GROUP BY 1 HAVING count(*) >= 40)""",
                        ctes=(("tpts", _T_POINTS.format(keys="")), ("tclip", _T_CLIP))))
def q_sort_bands(spark, sf):
    # The trend has one row per 2-degree band (a few dozen rows): numbering its
    # sorted rows in one window partition is bounded by the band count.
    t = D.temp_delay_trend(X.clean(spark, sf)).select("temp_band", "flight_count")
    return t.withColumn("band_pos", F.row_number().over(Window.orderBy("temp_band")).cast("bigint"))


@query("sample_points", W(f"""
SELECT {KS}, round(temperature_c, 6) AS temperature_c, round(arrival_delay_clip, 6) AS arrival_delay
FROM tclip
ORDER BY md5(concat_ws('|', {", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in KEY)}, '42')),
         {KS}
LIMIT 2000""", ctes=(("tpts", _T_POINTS.format(keys=KS + ", ")), ("tclip", _T_CLIP))))
def q_sample_points(spark, sf):
    s = D.temp_delay_sample(X.clean(spark, sf), KEY)
    return s.select(*KEY, r6("temperature_c").alias("temperature_c"),
                    r6("arrival_delay").alias("arrival_delay"))


@query("rain_delay_scatter", W("""
SELECT round(prcp, 6) AS prcp, Average_Delay FROM scatter""", ctes=(("scatter", _SCATTER),)))
def q_rain_delay_scatter(spark, sf):
    s = D.rain_delay_scatter(X.clean(spark, sf))
    return s.select(r6("prcp").alias("prcp"), "Average_Delay")


@query("rain_delay_trend", W("""
SELECT rain_band, round(avg_delay, 6) AS avg_delay, point_count FROM rtrend""",
                              ctes=(("scatter", _SCATTER), ("rainf", _RAIN_F),
                                    ("rtrend", _RAIN_TREND))))
def q_rain_delay_trend(spark, sf):
    t = D.rain_delay_trend(D.rain_delay_scatter(X.clean(spark, sf)))
    return t.select("rain_band", r6("avg_delay").alias("avg_delay"), "point_count")


@query("airport_delay_map", W(f"""
SELECT a.IATA_CODE AS Dep_Airport, a.LATITUDE, a.LONGITUDE,
       coalesce(m.avg_delay, 0.0) AS Average_Delay,
       least(greatest(coalesce(m.avg_delay, 0.0), -15), 45) AS Average_Delay_Display,
       round(10 + greatest(least(greatest(coalesce(m.avg_delay, 0.0), -15), 45), 0.0) * 0.8, 6)
         AS Bubble_Size
FROM airports a LEFT JOIN (
  SELECT Dep_Airport, {RE("avg(Arr_Delay)", 2)} AS avg_delay FROM clean GROUP BY 1) m
  ON a.IATA_CODE = m.Dep_Airport"""))
def q_airport_delay_map(spark, sf):
    m = D.airport_delay_map(X.clean(spark, sf), X.airports(spark, sf))
    return m.withColumn("Bubble_Size", r6("Bubble_Size"))


@query("delay_heatmap", W("SELECT * FROM heatmap", ctes=(("heat", _HEAT), ("heatmap", _HEATMAP))))
def q_delay_heatmap(spark, sf):
    return D.delay_heatmap(_heat_input(spark, sf))


_PIVOT_SQL = ("SELECT d.day_pos, d.Day, " + ", ".join(
    RE(f"coalesce(max(CASE WHEN h.DepTime_label = '{t}' THEN h.Average_Delay END), 0.0)", 2)
    + f" AS {t}" for t in K.TIME_ORDER)
    + " FROM (VALUES " + ", ".join(f"({i + 1}, '{d}')" for i, d in enumerate(K.DAY_ORDER))
    + ") d(day_pos, Day) LEFT JOIN heatmap h ON d.Day = h.Day GROUP BY d.day_pos, d.Day")


@query("heatmap_pivot", W(_PIVOT_SQL, ctes=(("heat", _HEAT), ("heatmap", _HEATMAP))))
def q_heatmap_pivot(spark, sf):
    return D.heatmap_pivot(D.delay_heatmap(_heat_input(spark, sf)))


_DAYS = "[" + ", ".join(f"'{d}'" for d in K.DAY_ORDER) + "]"
_TIMES = "[" + ", ".join(f"'{t}'" for t in K.TIME_ORDER) + "]"


@query("ordered_categorical_sort", W(f"""
SELECT Day, DepTime_label, Average_Delay,
       row_number() OVER (ORDER BY list_position({_DAYS}, Day),
                                   list_position({_TIMES}, DepTime_label)) AS sort_pos
FROM heatmap""", ctes=(("heat", _HEAT), ("heatmap", _HEATMAP))))
def q_ordered_categorical_sort(spark, sf):
    # At most 7 x 4 cells: the ordered numbering runs on that bounded table.
    h = D.delay_heatmap(_heat_input(spark, sf)).select("Day", "DepTime_label", "Average_Delay")
    days = F.array(*[F.lit(d) for d in K.DAY_ORDER])
    times = F.array(*[F.lit(t) for t in K.TIME_ORDER])
    w = Window.orderBy(F.array_position(days, F.col("Day")),
                       F.array_position(times, F.col("DepTime_label")))
    return h.withColumn("sort_pos", F.row_number().over(w).cast("bigint"))


@query("monthly_avg_delay", W(f"""
SELECT month_num, {_MONTHS}[month_num] AS Month, Average_Arrival_Delay_Minutes FROM monthly""",
                              ctes=(("monthly", _MONTHLY),)))
def q_monthly_avg_delay(spark, sf):
    return D.monthly_avg_delay(X.clean(spark, sf))


@query("monthly_delay_count", W(f"""
SELECT month_num, {_MONTHS}[month_num] AS Month, Total_Delays FROM monthly""",
                                ctes=(("monthly", _MONTHLY),)))
def q_monthly_delay_count(spark, sf):
    return D.monthly_delay_count(X.clean(spark, sf))


@query("airline_ranking", W("SELECT * FROM ranking", ctes=(("ranking", _RANKING),)))
def q_airline_ranking(spark, sf):
    return D.airline_ranking(X.clean(spark, sf))


@query("summary_peaks", W(f"""
(SELECT 'peak_month' AS metric, {_MONTHS}[month_num] AS label,
        Average_Arrival_Delay_Minutes AS value
 FROM monthly ORDER BY Average_Arrival_Delay_Minutes DESC, month_num LIMIT 1)
UNION ALL
(SELECT 'top_airline' AS metric, Airline AS label, Average_Arrival_Delay AS value
 FROM ranking ORDER BY Average_Arrival_Delay DESC, Airline LIMIT 1)
UNION ALL
(SELECT 'delay_volume_peak' AS metric, {_MONTHS}[month_num] AS label,
        CAST(Total_Delays AS DOUBLE) AS value
 FROM monthly ORDER BY Total_Delays DESC, month_num LIMIT 1)""",
                          ctes=(("monthly", _MONTHLY), ("ranking", _RANKING))))
def q_summary_peaks(spark, sf):
    c = X.clean(spark, sf)
    return D.summary_peaks(D.monthly_avg_delay(c), D.airline_ranking(c), D.monthly_delay_count(c))


@query("bubble_size", W(f"""
SELECT {KS}, least(greatest(Arr_Delay, -15), 45) AS display_delay,
       round(10 + greatest(least(greatest(Arr_Delay, -15), 45), 0) * CAST(0.8 AS DOUBLE), 6)
         AS bubble_size
FROM clean"""))
def q_bubble_size(spark, sf):
    from delaylake.functions import columns as C
    c = X.clean(spark, sf)
    disp = C.clip("Arr_Delay", *K.MAP_DISPLAY_CLIP)
    return c.select(*KEY, disp.alias("display_delay"),
                    r6(C.bubble_size(disp)).alias("bubble_size"))


@query("delay_level", W(f"""
SELECT Airline, avg_delay,
       CASE WHEN avg_delay < 15 THEN 'Low' WHEN avg_delay IS NOT NULL THEN 'Medium' END AS Delay_Level
FROM (SELECT Airline, {RE("avg(Arr_Delay)", 2)} AS avg_delay FROM clean GROUP BY 1)"""))
def q_delay_level(spark, sf):
    from delaylake.functions import columns as C
    g = X.clean(spark, sf).groupBy("Airline").agg(F.bround(F.avg("Arr_Delay"), 2).alias("avg_delay"))
    return g.select("Airline", "avg_delay", C.delay_level("avg_delay").alias("Delay_Level"))

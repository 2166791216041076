"""Registered compositions: the two other preprocessing chains and the whole
dashboard payload."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylake.functions import constants as K
from delaylake.plans import chains
from delaylake.plans import dashboard as DB
from delaylake.plans import fixtures as X
from delaylake.plans import state as ST
from delaylake.plans.oracle import round_even as RE
from delaylake.plans.oracle import with_views as W
from delaylake.plans.q_core import _bucket_sql
from delaylake.plans.q_dashboard import (_HEAT, _MONTHLY, _MONTHS, _RAIN_F, _RAIN_TREND, _RANKING, _SCATTER,
                                         _T_CLIP, _T_POINTS)
from delaylake.plans.q_features import _DUMMY_CATS
from delaylake.plans.registry import query
from delaylake.session import scratch_path
from delaylake.sources.views import FLIGHT_KEY

KEY = list(FLIGHT_KEY)
KS = ", ".join(KEY)
_BRANDS = [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]
CATS = {"Airline": _BRANDS, **_DUMMY_CATS}
_HOT_SQL = ", ".join(f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS \"{c}_{v}\""
                     for c, vs in CATS.items() for v in vs[1:])


def r6(c):
    return F.round(c, 6)


# Two years: the flights up to 1998, and the later ones without tail and age.
_STACKED = ("stacked", """
SELECT * FROM flights WHERE year(FlightDate) <= 1998
UNION ALL BY NAME
SELECT * EXCLUDE (Aicraft_age, Tail_Number) FROM flights WHERE year(FlightDate) > 1998""")
_KEPT = ("kept", """
SELECT f.*, a.LATITUDE, a.LONGITUDE, w.tavg, w.prcp, w.wspd, w.pres
FROM (SELECT DISTINCT * FROM stacked s WHERE NOT EXISTS (
        SELECT 1 FROM cancelled c
        WHERE c.FlightDate IS NOT DISTINCT FROM s.FlightDate AND c.Airline IS NOT DISTINCT FROM s.Airline
          AND c.Tail_Number IS NOT DISTINCT FROM s.Tail_Number)) f
LEFT JOIN airports a ON f.Dep_Airport = a.IATA_CODE
LEFT JOIN weather w ON f.Dep_Airport = w.airport_id AND f.FlightDate = w.time""")
_GROUPED = ("grouped", "SELECT k.*, " + ", ".join(
    f"coalesce(CAST(k.{c} AS DOUBLE), g.g_{c}) AS f_{c}" for c in K.WEATHER_COLS)
    + " FROM kept k LEFT JOIN (SELECT Dep_Airport, " + ", ".join(
        f"CAST(sum({c}) AS DOUBLE) / count({c}) AS g_{c}" for c in K.WEATHER_COLS)
    + " FROM kept GROUP BY 1) g ON k.Dep_Airport = g.Dep_Airport")
_CODES = tuple((f"code_{c}", f"SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM "
                             f"(SELECT DISTINCT {c} AS v FROM kept WHERE {c} IS NOT NULL)")
               for c in ("Dep_Airport", "Arr_Airport"))


@query("etl_stacked_features", W(f"""
SELECT {KS}, CAST(d.i AS DOUBLE) AS Dep_Airport_Encoded, CAST(e.i AS DOUBLE) AS Arr_Airport_Encoded,
       CAST(Day_Of_Week AS DOUBLE) AS Day_Of_Week, CAST(Flight_Duration AS DOUBLE) AS Flight_Duration,
       CAST(coalesce(Aicraft_age, (SELECT median(Aicraft_age) FROM kept), 0) AS DOUBLE) AS Aicraft_age,
       """ + ", ".join(f"round(coalesce(f_{c}, (SELECT median(f_{c}) FROM grouped), 0), 6) AS {c}"
                       for c in K.WEATHER_COLS) + f""",
       CAST(month(FlightDate) AS DOUBLE) AS month, CAST(day(FlightDate) AS DOUBLE) AS day,
       CAST(CASE WHEN Day_Of_Week IN (6, 7) THEN 1 ELSE 0 END AS DOUBLE) AS is_weekend,
       coalesce(LATITUDE, 0.0) AS LATITUDE, coalesce(LONGITUDE, 0.0) AS LONGITUDE, {_HOT_SQL},
       CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END AS is_delayed
FROM grouped LEFT JOIN code_Dep_Airport d ON Dep_Airport = d.v LEFT JOIN code_Arr_Airport e ON Arr_Airport = e.v
""", ctes=(_STACKED, _KEPT, _GROUPED, *_CODES)))
def q_etl_stacked_features(spark, sf):
    f = X.flights(spark, sf)
    years = (f.where(F.year("FlightDate") <= 1998),
             f.where(F.year("FlightDate") > 1998).drop("Aicraft_age", "Tail_Number"))
    out = chains.stacked_features(years, X.cancelled(spark, sf), X.airports(spark, sf),
                                  X.weather(spark, sf), CATS, KEY)
    return out.select(*[r6(c).alias(c) if c in K.WEATHER_COLS else F.col(f"`{c}`") for c in out.columns])


@query("etl_phase1_rows", W(f"""
SELECT {KS}, Flight_Duration, Aicraft_age, tavg, prcp, wspd, is_delayed, {_HOT_SQL}
FROM (SELECT f.* REPLACE (coalesce(f.Aicraft_age, 10) AS Aicraft_age),
             coalesce(CAST(w.tavg AS DOUBLE), 10.0) AS tavg, coalesce(CAST(w.prcp AS DOUBLE), 0.0) AS prcp,
             coalesce(CAST(w.wspd AS DOUBLE), 5.0) AS wspd,
             CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END AS is_delayed
      FROM f_anti f LEFT JOIN weather w ON f.Dep_Airport = w.airport_id AND f.FlightDate = w.time)
WHERE Airline IS NOT NULL AND DepTime_label IS NOT NULL AND Distance_type IS NOT NULL
  AND Flight_Duration IS NOT NULL AND {_bucket_sql(KEY)} < 500"""))
def q_etl_phase1_rows(spark, sf):
    return chains.phase1_rows(X.flights(spark, sf), X.cancelled(spark, sf), X.weather(spark, sf), KEY, CATS)


_CELLS = ("cells", f"""
SELECT 'monthly_delay' AS section, {_MONTHS}[month_num] AS key, CAST(Average_Arrival_Delay_Minutes AS DOUBLE) AS value
FROM monthly
UNION ALL SELECT 'monthly_delay_count', {_MONTHS}[month_num], CAST(Total_Delays AS DOUBLE) FROM monthly
UNION ALL SELECT 'top_airlines', Airline, Average_Arrival_Delay FROM ranking
UNION ALL SELECT 'airport_map', a.IATA_CODE, coalesce(m.avg_delay, 0.0) FROM airports a LEFT JOIN (
  SELECT Dep_Airport, {RE("avg(Arr_Delay)", 2)} AS avg_delay FROM clean GROUP BY 1) m ON a.IATA_CODE = m.Dep_Airport
UNION ALL SELECT 'delay_heatmap', Day || ' ' || DepTime_label, Average_Delay FROM heat
UNION ALL SELECT 'precipitation_scatter', CAST(CAST(round(prcp * 1000000) AS BIGINT) AS VARCHAR), Average_Delay
  FROM scatter
UNION ALL SELECT 'precipitation_trend', CAST(rain_band AS VARCHAR), avg_delay FROM rtrend
UNION ALL SELECT 'temperature_trend', CAST(CAST({RE("temperature_c / 2", 0)} * 2 AS INTEGER) AS VARCHAR),
  avg(arrival_delay_clip) FROM tclip GROUP BY 2 HAVING count(*) >= 40""")
_VALUES = {"monthly_delay": ("Month", "Average_Arrival_Delay_Minutes"),
           "monthly_delay_count": ("Month", "Total_Delays"),
           "top_airlines": ("Airline", "Average_Arrival_Delay"),
           "airport_map": ("Dep_Airport", "Average_Delay"),
           "delay_heatmap": ("concat_ws(' ', Day, DepTime_label)", "Average_Delay"),
           "precipitation_scatter": ("cast(cast(round(prcp * 1000000) as bigint) as string)", "Average_Delay"),
           "precipitation_trend": ("cast(rain_band as string)", "avg_delay"),
           "temperature_trend": ("cast(temp_band as string)", "avg_delay")}


_CELLS_SQL = W("SELECT section, key, round(value, 6) AS value FROM cells", ctes=(
    ("monthly", _MONTHLY), ("ranking", _RANKING), ("heat", _HEAT), ("scatter", _SCATTER), ("rainf", _RAIN_F),
    ("rtrend", _RAIN_TREND), ("tpts", _T_POINTS.format(keys="")), ("tclip", _T_CLIP), _CELLS))


def _cells(tables):
    parts = [tables[name].select(F.lit(name).alias("section"), F.expr(key).alias("key"),
                                 r6(F.col(value).cast("double")).alias("value"))
             for name, (key, value) in _VALUES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dashboard_tables", _CELLS_SQL)
def q_dashboard_tables(spark, sf):
    """Every section of the payload as (section, key, value), from the one-pass
    plan that the dashboard writes."""
    return _cells(DB.dashboard_tables(X.clean(spark, sf), X.airports(spark, sf), KEY))


@query("dashboard_state", _CELLS_SQL)
def q_dashboard_state(spark, sf):
    """The same sections from a state to which the flights were added in three batches of days,
    one of them twice."""
    clean, path = X.clean(spark, sf), scratch_path(spark, "dashboard-state")
    for batch in (0, 1, 2, 1):
        ST.add_batch(spark, path, f"days-{batch}", clean.where(F.dayofyear("FlightDate") % 3 == batch), KEY)
    return _cells(ST.dashboard_from_state(spark, path, X.airports(spark, sf), KEY))

"""Registered queries: sources/sinks, projection and scalars, joins, cleaning,
"""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import aggregates as A
from delaylake.operators import clean as CL
from delaylake.operators import joins as J
from delaylake.operators import projection as P
from delaylake.operators import sampling as S
from delaylake.operators.quantiles import exact_quantiles
from delaylake.plans import fixtures as X
from delaylake.plans.oracle import avg_round_even, round_even
from delaylake.plans.oracle import with_views as W
from delaylake.plans.registry import query
from delaylake.session import materialize
from delaylake.sources import log as LOG
from delaylake.sources.tables import load_driver_table, read_parquet_table
from delaylake.sources.views import FLIGHT_KEY

KEY = list(FLIGHT_KEY)
KS = ", ".join(KEY)
R6 = 6  # decimals kept for double outputs on both sides


def r6(c):
    return F.round(c, R6)


# --------------------------------------------------------------------------- 2.1

@query("read_parquet_table", "SELECT * FROM lineitem")
def q_read_parquet_table(spark, sf):
    return read_parquet_table(spark, f"{sf.rstrip('/')}/lineitem.parquet")


_LOG_COLS = ("event_id, \"timestamp\", source, delay_prob, on_time_prob, prediction, risk")


@query("prediction_history", W(f"""
SELECT {_LOG_COLS} FROM log_t ORDER BY "timestamp" DESC, event_id LIMIT 25"""))
def q_prediction_history(spark, sf):
    log = X.log_table(spark, sf).select(*[c.strip().strip('"') for c in _LOG_COLS.split(",")])
    return LOG.prediction_history(log, 25, tie="event_id")


@query("topk", W(f"""
SELECT {_LOG_COLS} FROM log_t ORDER BY "timestamp" DESC, event_id LIMIT 10"""))
def q_topk(spark, sf):
    log = X.log_table(spark, sf).select(*[c.strip().strip('"') for c in _LOG_COLS.split(",")])
    return LOG.prediction_history(log, 10, tie="event_id")


@query("history_display", W("""
SELECT "timestamp", coalesce(source, 'flask') AS source,
       coalesce(route, '—') AS route, coalesce(airline, '—') AS airline,
       coalesce(travel_date, '—') AS travel_date, coalesce(dep_time, '—') AS dep_time,
       delay_prob, coalesce(risk, 'low') AS risk,
       CASE coalesce(risk, 'low') WHEN 'high' THEN 'DELAYED' WHEN 'medium' THEN 'POSSIBLY DELAYED'
            ELSE 'ON TIME' END AS risk_label,
       coalesce(model_used, '—') AS model_used
FROM log_t"""))
def q_history_display(spark, sf):
    return LOG.history_display(X.log_table(spark, sf))


# --------------------------------------------------------------------------- 2.2

_AVAILABLE = ["FlightDate", "Airline", "Dep_Airport", "Arr_Airport", "tavg", "prcp",
              "Day_Of_Week", "Aicraft_age", "Flight_Duration", "DepTime_label"]


@query("select_available", W("""
SELECT FlightDate, Airline, Dep_Airport, Arr_Airport, Day_Of_Week, Aicraft_age,
       Flight_Duration, DepTime_label FROM flights"""))
def q_select_available(spark, sf):
    return P.select_available(X.flights(spark, sf), _AVAILABLE)


@query("drop_leakage", W("SELECT * EXCLUDE (Arr_Delay, Dep_Delay, Tail_Number) FROM flights"))
def q_drop_leakage(spark, sf):
    return P.drop_leakage(X.flights(spark, sf))


@query("drop_missing", W("SELECT * FROM flights WHERE COLUMNS(*) IS NOT NULL"))
def q_drop_missing(spark, sf):
    return P.drop_missing(X.flights(spark, sf))


@query("delay_label", W(f"""
SELECT {KS}, CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END AS delay_label FROM flights"""))
def q_delay_label(spark, sf):
    return X.flights(spark, sf).select(*KEY, C.delay_label("Arr_Delay").alias("delay_label"))


@query("to_date_lenient", W(f"""
SELECT {KS}, CAST(try_strptime(travel_date, '%Y-%m-%d') AS DATE) AS parsed_date
FROM date_texts""", ctes=(("date_texts", X.DATE_TEXTS_SQL),)))
def q_to_date_lenient(spark, sf):
    d = X.date_texts(spark, sf)
    return d.select(*KEY, C.to_date_lenient("travel_date", "yyyy-MM-dd").alias("parsed_date"))


@query("to_number_lenient", W(f"""
SELECT {KS}, TRY_CAST(txt AS DOUBLE) AS number FROM (
  SELECT {KS}, CASE WHEN l_linenumber = 2 THEN 'abc' WHEN l_linenumber = 3 THEN NULL
                    ELSE CAST(Flight_Duration AS VARCHAR) END AS txt FROM flights)"""))
def q_to_number_lenient(spark, sf):
    f = X.flights(spark, sf)
    txt = (F.when(F.col("l_linenumber") == 2, F.lit("abc"))
            .when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
            .otherwise(F.col("Flight_Duration").cast("string")))
    return f.select(*KEY, C.to_number_lenient(txt).alias("number"))


@query("fill_constants", W(f"""
SELECT {KS}, coalesce(CAST(tavg AS DOUBLE), 10.0) AS tavg, coalesce(CAST(prcp AS DOUBLE), 0.0) AS prcp,
       coalesce(CAST(wspd AS DOUBLE), 5.0) AS wspd, coalesce(CAST(pres AS DOUBLE), 1010.0) AS pres,
       coalesce(Aicraft_age, 10) AS Aicraft_age
FROM f_weather"""))
def q_fill_constants(spark, sf):
    f = X.f_weather(spark, sf)
    f = f.select(*KEY, *[F.col(c).cast("double").alias(c) for c in K.WEATHER_COLS], "Aicraft_age")
    return P.fill_constants(f, K.FILL_PHASE1)


@query("clip", W(f"""
SELECT {KS}, CASE WHEN Arr_Delay IS NULL THEN NULL
                  ELSE least(greatest(Arr_Delay, -30), 300) END AS Arr_Delay_clip FROM flights"""))
def q_clip(spark, sf):
    return X.flights(spark, sf).select(*KEY, C.clip("Arr_Delay", -30, 300).alias("Arr_Delay_clip"))


@query("calendar_features", W(f"""
SELECT {KS}, CAST(year(FlightDate) AS INTEGER) AS year, CAST(month(FlightDate) AS INTEGER) AS month,
       CAST(day(FlightDate) AS INTEGER) AS day, CAST(dayofweek(FlightDate) + 1 AS INTEGER) AS day_of_week
FROM flights"""))
def q_calendar_features(spark, sf):
    f = X.flights(spark, sf).select(*KEY, "FlightDate")
    return P.calendar_features(f).drop("FlightDate")


@query("weekend_flag", W(f"""
SELECT {KS}, CASE WHEN Day_Of_Week IN (6, 7) THEN 1 ELSE 0 END AS is_weekend FROM flights"""))
def q_weekend_flag(spark, sf):
    f = X.flights(spark, sf).select(*KEY, "Day_Of_Week")
    return P.add_weekend_flag(f).drop("Day_Of_Week")


@query("parse_travel_date", W(f"""
SELECT {KS}, CAST(coalesce(month(d), 1) AS INTEGER) AS req_month,
       CAST(coalesce(day(d), 1) AS INTEGER) AS req_day,
       CAST(coalesce(isodow(d), 1) AS INTEGER) AS req_iso_dow,
       coalesce(strftime(d, '%A'), 'Monday') AS req_day_name,
       coalesce(isodow(d) >= 6, false) AS req_is_weekend
FROM (SELECT *, CAST(try_strptime(travel_date, '%Y-%m-%d') AS DATE) AS d FROM date_texts)""",
          ctes=(("date_texts", X.DATE_TEXTS_SQL),)))
def q_parse_travel_date(spark, sf):
    return P.parse_travel_date(X.date_texts(spark, sf)).drop("travel_date")


@query("temp_range_filter", W(f"""
SELECT {KS}, round(tavg, 6) AS temperature_c FROM clean WHERE tavg BETWEEN -35 AND 45"""))
def q_temp_range_filter(spark, sf):
    c = X.clean(spark, sf).select(*KEY, F.col("tavg").alias("temperature_c"))
    return P.temp_range_filter(c).select(*KEY, r6("temperature_c").alias("temperature_c"))


@query("temp_band", W(f"""
SELECT {KS}, CAST({round_even("tavg / 2", 0)} * 2 AS INTEGER) AS temp_band FROM clean"""))
def q_temp_band(spark, sf):
    return X.clean(spark, sf).select(*KEY, C.temp_band("tavg").alias("temp_band"))


@query("rain_band", W(f"""
SELECT {KS}, CAST(floor(prcp / 2) * 2 AS INTEGER) AS rain_band FROM clean"""))
def q_rain_band(spark, sf):
    return X.clean(spark, sf).select(*KEY, C.rain_band("prcp").alias("rain_band"))


@query("route_label", W("""
SELECT request_id, concat_ws(' → ', dep_airport, arr_airport) AS route FROM requests"""))
def q_route_label(spark, sf):
    r = X.requests(spark, sf)
    return r.select("request_id", C.route_label("dep_airport", "arr_airport").alias("route"))


_MESSY_SQL = """
SELECT request_id,
       CASE WHEN l_partkey % 11 = 0 THEN '  ' ELSE ' ' || Airline END AS airline_key,
       lower('  ' || Dep_Airport) AS dep_airport,
       CASE WHEN Aicraft_age IS NULL THEN NULL ELSE Arr_Airport || ' ' END AS arr_airport,
       CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE DepTime_label END AS dep_time
FROM (SELECT *, concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                          CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS request_id
      FROM flights)
"""


def _messy_requests(spark, sf):
    from delaylake.sources.views import request_id
    f = X.flights(spark, sf)
    return f.select(
        request_id().alias("request_id"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit("  "))
         .otherwise(F.concat(F.lit(" "), F.col("Airline"))).alias("airline_key"),
        F.lower(F.concat(F.lit("  "), F.col("Dep_Airport"))).alias("dep_airport"),
        F.when(F.col("Aicraft_age").isNull(), F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("Arr_Airport"), F.lit(" "))).alias("arr_airport"),
        F.when(F.col("l_suppkey") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("DepTime_label")).alias("dep_time"))


@query("normalise_code", W("""
SELECT request_id, airline_key, dep_airport, arr_airport, dep_time,
       CASE WHEN airline_key = '' THEN 'missing airline'
            WHEN dep_airport = '' THEN 'missing departure airport'
            WHEN coalesce(arr_airport, '') = '' THEN 'missing arrival airport' END AS reject_reason
FROM (SELECT request_id, trim(airline_key) AS airline_key, upper(trim(dep_airport)) AS dep_airport,
             upper(trim(arr_airport)) AS arr_airport, coalesce(dep_time, 'Morning') AS dep_time
      FROM messy)""", ctes=(("messy", _MESSY_SQL),)))
def q_normalise_code(spark, sf):
    valid, rejected = P.validate_requests(_messy_requests(spark, sf))
    return valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


_DISPLAY_CASE = "CASE airline_key " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.AIRLINE_DISPLAY.items()) + " ELSE airline_key END"
_MAPPED = sorted(K.AIRLINE_DISPLAY)
# Two suppliers in three fly for an airline that the map has, the others for a brand.
_KEYED_SQL = (f"SELECT *, CASE WHEN l_suppkey % 3 < 2 THEN [" + ", ".join(f"'{k}'" for k in _MAPPED)
              + f"][1 + l_suppkey % {len(_MAPPED)}] ELSE Airline END AS airline_key FROM flights")


@query("airline_display", W(f"SELECT {KS}, airline_key, {_DISPLAY_CASE} AS airline FROM keyed",
                            ctes=(("keyed", _KEYED_SQL),)))
def q_airline_display(spark, sf):
    mapped = F.element_at(F.array(*[F.lit(k) for k in _MAPPED]),
                          (1 + F.col("l_suppkey") % len(_MAPPED)).cast("int"))
    f = X.flights(spark, sf).withColumn(
        "airline_key", F.when(F.col("l_suppkey") % 3 < 2, mapped).otherwise(F.col("Airline")))
    return f.select(*KEY, "airline_key", C.airline_display("airline_key").alias("airline"))


@query("risk_bracket", W("""
SELECT event_id,
       CASE WHEN delay_prob >= 0.40 THEN 'high' WHEN delay_prob >= 0.25 THEN 'medium'
            WHEN delay_prob IS NOT NULL THEN 'low' END AS risk,
       CASE WHEN delay_prob >= 0.40 THEN 'DELAYED' WHEN delay_prob >= 0.25 THEN 'POSSIBLY DELAYED'
            WHEN delay_prob IS NOT NULL THEN 'ON TIME' END AS label,
       CASE WHEN delay_prob >= 0.40 THEN 'High Delay Risk'
            WHEN delay_prob >= 0.25 THEN 'Moderate Risk — Monitor Flight'
            WHEN delay_prob IS NOT NULL THEN 'Low Risk' END AS verdict
FROM plog"""))
def q_risk_bracket(spark, sf):
    rb = C.risk_bracket("delay_prob")
    return X.plog(spark, sf).select("event_id", rb["risk"].alias("risk"),
                                    rb["label"].alias("label"), rb["verdict"].alias("verdict"))


@query("percent_fields", W(f"""
SELECT event_id, {round_even("delay_prob * 100", 1)} AS delay_pct,
       {round_even("(1 - delay_prob) * 100", 1)} AS on_time_pct FROM plog"""))
def q_percent_fields(spark, sf):
    d, o = C.percent_fields("delay_prob")
    return X.plog(spark, sf).select("event_id", d.alias("delay_pct"), o.alias("on_time_pct"))


@query("confidence_threshold", W("""
SELECT event_id, CAST(delay_prob > 0.6 AS INTEGER) AS prediction FROM plog"""))
def q_confidence_threshold(spark, sf):
    return X.plog(spark, sf).select("event_id",
                                    C.confidence_threshold("delay_prob").alias("prediction"))


# --------------------------------------------------------------------------- 2.3

@query("cancel_anti_join", W("SELECT * FROM f_anti"))
def q_cancel_anti_join(spark, sf):
    return J.cancel_anti_join(X.flights(spark, sf), X.cancelled(spark, sf))


@query("cancel_anti_join_nullsafe", W("""
SELECT * FROM flights f WHERE NOT EXISTS (
  SELECT 1 FROM cancelled c
  WHERE c.FlightDate IS NOT DISTINCT FROM f.FlightDate AND c.Airline IS NOT DISTINCT FROM f.Airline
    AND c.Tail_Number IS NOT DISTINCT FROM f.Tail_Number)"""))
def q_cancel_anti_join_nullsafe(spark, sf):
    return J.cancel_anti_join(X.flights(spark, sf), X.cancelled(spark, sf), null_safe=True)


@query("join_airport_coords", W("""
SELECT f.*, a.LATITUDE, a.LONGITUDE FROM flights f LEFT JOIN airports a ON f.Dep_Airport = a.IATA_CODE"""))
def q_join_airport_coords(spark, sf):
    return J.join_airport_coords(X.flights(spark, sf), X.airports(spark, sf))


@query("join_daily_weather", W("""
SELECT * REPLACE (CAST(tavg AS DOUBLE) AS tavg, CAST(prcp AS DOUBLE) AS prcp,
                  CAST(wspd AS DOUBLE) AS wspd, CAST(pres AS DOUBLE) AS pres)
FROM f_weather"""))
def q_join_daily_weather(spark, sf):
    j = J.join_daily_weather(X.flights(spark, sf), X.weather(spark, sf))
    return j.select(*[F.col(c).cast("double").alias(c) if c in K.WEATHER_COLS else F.col(c)
                      for c in j.columns])


@query("join_target_rates", W(f"""
SELECT {KS}, Dep_Airport, Arr_Airport, delay_label,
       round(avg(delay_label) OVER (PARTITION BY Dep_Airport), 6) AS dep_airport_delay_avg,
       round(avg(delay_label) OVER (PARTITION BY Arr_Airport), 6) AS arr_airport_delay_avg
FROM f_label"""))
def q_join_target_rates(spark, sf):
    f = X.f_label(spark, sf).select(*KEY, "Dep_Airport", "Arr_Airport", "delay_label")
    j = J.join_target_rates(f)
    return j.select(*KEY, "Dep_Airport", "Arr_Airport", "delay_label",
                    r6("dep_airport_delay_avg").alias("dep_airport_delay_avg"),
                    r6("arr_airport_delay_avg").alias("arr_airport_delay_avg"))


_WAVG_SQL = f"""
SELECT airport_id, CAST(month(time) AS INTEGER) AS month,
       {avg_round_even("tavg")} AS tavg, {avg_round_even("prcp")} AS prcp,
       {avg_round_even("wspd")} AS wspd, {avg_round_even("pres")} AS pres
FROM weather WHERE airport_id IS NOT NULL AND time IS NOT NULL GROUP BY 1, 2
"""

_REQ_PARSED_SQL = """
SELECT r.*, CAST(coalesce(month(CAST(try_strptime(travel_date, '%Y-%m-%d') AS DATE)), 1) AS INTEGER)
       AS req_month FROM requests r
"""


@query("lookup_weather_default", W("""
SELECT q.request_id, q.dep_airport, q.req_month,
       coalesce(w.tavg, 15.0) AS tavg, coalesce(w.prcp, 2.0) AS prcp,
       coalesce(w.wspd, 15.0) AS wspd, coalesce(w.pres, 1013.0) AS pres
FROM rq q LEFT JOIN wavg w ON q.dep_airport = w.airport_id AND q.req_month = w.month""",
          ctes=(("wavg", _WAVG_SQL), ("rq", _REQ_PARSED_SQL))))
def q_lookup_weather_default(spark, sf):
    r = P.parse_travel_date(X.requests(spark, sf))
    wa = A.weather_monthly_avg(X.weather(spark, sf))
    out = J.lookup_weather_default(r, wa)
    return out.select("request_id", "dep_airport", "req_month", *K.WEATHER_COLS)


@query("lookup_coords_default", W("""
SELECT r.request_id, r.dep_airport, coalesce(a.LATITUDE, 39.0) AS LATITUDE,
       coalesce(a.LONGITUDE, -98.0) AS LONGITUDE
FROM requests r LEFT JOIN airports a ON r.dep_airport = a.IATA_CODE"""))
def q_lookup_coords_default(spark, sf):
    r = X.requests(spark, sf).select("request_id", "dep_airport")
    return J.lookup_coords_default(r, X.airports(spark, sf))


_RATE_SQL = "SELECT Dep_Airport, avg(delay_label) AS rate FROM clean GROUP BY 1"


@query("lookup_delay_default", W("""
SELECT r.request_id, round(coalesce(d.rate, 0.20), 6) AS dep_airport_delay_avg,
       round(coalesce(a.rate, 0.20), 6) AS arr_airport_delay_avg
FROM requests r LEFT JOIN rates d ON r.dep_airport = d.Dep_Airport
LEFT JOIN rates a ON r.arr_airport = a.Dep_Airport""", ctes=(("rates", _RATE_SQL),)))
def q_lookup_delay_default(spark, sf):
    rates = A.delay_rate(X.labelled(spark, sf))
    r = X.requests(spark, sf).select("request_id", "dep_airport", "arr_airport")
    out = J.lookup_delay_default(r, rates)
    return out.select("request_id", r6("dep_airport_delay_avg").alias("dep_airport_delay_avg"),
                      r6("arr_airport_delay_avg").alias("arr_airport_delay_avg"))


_ROUTE_SQL = """
SELECT r.*, 69 * sqrt(pow(abs(coalesce(d.LATITUDE, 39.0) - coalesce(a.LATITUDE, 41.9)), 2)
                    + pow(abs(coalesce(d.LONGITUDE, -98.0) - coalesce(a.LONGITUDE, -87.9)), 2)) AS dist
FROM requests r LEFT JOIN airports d ON r.dep_airport = d.IATA_CODE
LEFT JOIN airports a ON r.arr_airport = a.IATA_CODE
"""
_ROUTE_COLS = """
round(dist, 6) AS est_distance,
CAST(greatest(30, CAST(floor(dist / 8) AS INTEGER)) AS INTEGER) AS flight_duration,
CASE WHEN dist < 800 THEN 'Short Haul >1500Mi' WHEN dist < 1500 THEN 'Medium Haul <3000Mi'
     ELSE 'Long Haul <6000Mi' END AS route_type
"""


@query("route_estimate", W(f"""
SELECT request_id, dep_airport, arr_airport, {_ROUTE_COLS} FROM routes""",
                           ctes=(("routes", _ROUTE_SQL),)))
def q_route_estimate(spark, sf):
    r = X.requests(spark, sf).select("request_id", "dep_airport", "arr_airport")
    out = J.route_estimate(r, X.airports(spark, sf))
    return out.withColumn("est_distance", r6("est_distance"))


@query("autofill", W(f"""
SELECT q.request_id, q.airline_key, q.dep_airport, q.arr_airport, q.travel_date, q.dep_time,
       coalesce(strftime(CAST(try_strptime(q.travel_date, '%Y-%m-%d') AS DATE), '%A'), 'Monday')
         AS day_of_week,
       CASE WHEN coalesce(isodow(CAST(try_strptime(q.travel_date, '%Y-%m-%d') AS DATE)) >= 6, false)
            THEN 'Yes' ELSE 'No' END AS is_weekend,
       CAST(greatest(30, CAST(floor(q.dist / 8) AS INTEGER)) AS INTEGER) AS flight_duration,
       CASE WHEN q.dist < 800 THEN 'Short Haul >1500Mi' WHEN q.dist < 1500 THEN 'Medium Haul <3000Mi'
            ELSE 'Long Haul <6000Mi' END AS route_type,
       {round_even("coalesce(w.tavg, 15.0)", 2)} AS tavg, {round_even("coalesce(w.prcp, 2.0)", 2)} AS prcp,
       {round_even("coalesce(w.wspd, 15.0)", 2)} AS wspd, {round_even("coalesce(w.pres, 1013.0)", 2)} AS pres,
       12 AS aircraft_age
FROM (SELECT rt.*, CAST(coalesce(month(CAST(try_strptime(travel_date, '%Y-%m-%d') AS DATE)), 1)
                        AS INTEGER) AS req_month FROM routes rt) q
LEFT JOIN wavg w ON q.dep_airport = w.airport_id AND q.req_month = w.month""",
                     ctes=(("wavg", _WAVG_SQL), ("routes", _ROUTE_SQL))))
def q_autofill(spark, sf):
    return J.autofill(X.requests(spark, sf), A.weather_monthly_avg(X.weather(spark, sf)),
                      X.airports(spark, sf))


# --------------------------------------------------------------------------- 2.4

@query("row_count", W("SELECT count(*) AS row_count FROM flights"))
def q_row_count(spark, sf):
    return A.row_count(X.flights(spark, sf))


@query("dedup_rows", W("""
SELECT DISTINCT * FROM (SELECT * FROM flights UNION ALL SELECT * FROM flights WHERE l_linenumber = 1)"""))
def q_dedup_rows(spark, sf):
    f = X.flights(spark, sf)
    return CL.dedup_rows(f.unionByName(f.where(F.col("l_linenumber") == 1)))


def _fill_sql(kind: str) -> str:
    if kind == "mean":
        stats = ("SELECT " + ", ".join(f"CAST(sum({c}) AS DOUBLE) / count({c}) AS m_{c}"
                                        for c in K.WEATHER_COLS) + " FROM f_weather")
        cols = ", ".join(f"round(coalesce(CAST(f.{c} AS DOUBLE), m.m_{c}), 6) AS {c}"
                         for c in K.WEATHER_COLS)
        return f"SELECT {', '.join('f.' + k for k in KEY)}, {cols} FROM f_weather f CROSS JOIN ({stats}) m"
    raise ValueError(kind)


@query("impute_global_mean", W(_fill_sql("mean")))
def q_impute_global_mean(spark, sf):
    f = X.f_weather(spark, sf).select(*KEY, *K.WEATHER_COLS)
    out = CL.impute_global_mean(f, K.WEATHER_COLS)
    return out.select(*KEY, *[r6(c).alias(c) for c in K.WEATHER_COLS])


_GROUP_FILL_SQL = ("SELECT f.*, " + ", ".join(
    f"coalesce(CAST(f.{c} AS DOUBLE), g.g_{c}) AS gf_{c}" for c in K.WEATHER_COLS)
    + " FROM f_weather f LEFT JOIN (SELECT Dep_Airport, " + ", ".join(
        f"CAST(sum({c}) AS DOUBLE) / count({c}) AS g_{c}" for c in K.WEATHER_COLS)
    + " FROM f_weather GROUP BY 1) g ON f.Dep_Airport = g.Dep_Airport")


@query("impute_group_mean", W(f"""
SELECT {KS}, Dep_Airport, """ + ", ".join(f"round(gf_{c}, 6) AS {c}" for c in K.WEATHER_COLS)
                              + " FROM gfill", ctes=(("gfill", _GROUP_FILL_SQL),)))
def q_impute_group_mean(spark, sf):
    f = X.f_weather(spark, sf).select(*KEY, "Dep_Airport", *K.WEATHER_COLS)
    out = CL.impute_group_mean(f, K.WEATHER_COLS, "Dep_Airport")
    return out.select(*KEY, "Dep_Airport", *[r6(c).alias(c) for c in K.WEATHER_COLS])


@query("impute_global_median", W(f"""
SELECT {KS}, Dep_Airport, """ + ", ".join(
    f"round(coalesce(gf_{c}, (SELECT median(gf_{c}) FROM gfill)), 6) AS {c}" for c in K.WEATHER_COLS)
    + " FROM gfill", ctes=(("gfill", _GROUP_FILL_SQL),)))
def q_impute_global_median(spark, sf):
    f = X.f_weather(spark, sf).select(*KEY, "Dep_Airport", *K.WEATHER_COLS)
    out = CL.impute_group_then_median(f, K.WEATHER_COLS, "Dep_Airport")
    return out.select(*KEY, "Dep_Airport", *[r6(c).alias(c) for c in K.WEATHER_COLS])


@query("window_group_mean", W(f"""
SELECT {KS}, Dep_Airport, Arr_Delay,
       round(avg(Arr_Delay) OVER (PARTITION BY Dep_Airport), 6) AS airport_mean_delay FROM flights"""))
def q_window_group_mean(spark, sf):
    # Same answer as avg().over(partitionBy(airport)), planned as aggregate +
    # join so a hub airport is not gathered into one task.
    f = X.flights(spark, sf).select(*KEY, "Dep_Airport", "Arr_Delay")
    g = materialize(f.groupBy("Dep_Airport").agg(F.avg("Arr_Delay").alias("airport_mean_delay")),
                    "airport-mean")
    return f.join(g, "Dep_Airport", "left").select(
        *KEY, "Dep_Airport", "Arr_Delay", r6("airport_mean_delay").alias("airport_mean_delay"))


@query("airport_delay_rate", W("""
SELECT Dep_Airport, round(avg(delay_label), 6) AS dep_airport_delay_avg FROM clean GROUP BY 1"""))
def q_airport_delay_rate(spark, sf):
    r = A.delay_rate(X.labelled(spark, sf), "Dep_Airport", alias="dep_airport_delay_avg")
    return r.select("Dep_Airport", r6("dep_airport_delay_avg").alias("dep_airport_delay_avg"))


@query("arrival_delay_rate", W("""
SELECT Arr_Airport, round(avg(delay_label), 6) AS arr_airport_delay_avg FROM clean GROUP BY 1"""))
def q_arrival_delay_rate(spark, sf):
    r = A.delay_rate(X.labelled(spark, sf), "Arr_Airport", alias="arr_airport_delay_avg")
    return r.select("Arr_Airport", r6("arr_airport_delay_avg").alias("arr_airport_delay_avg"))


@query("weather_monthly_avg", W(_WAVG_SQL))
def q_weather_monthly_avg(spark, sf):
    return A.weather_monthly_avg(X.weather(spark, sf))


@query("route_stats", W("""
SELECT m.Dep_Airport, m.Arr_Airport, m.avg_duration, t.distance_type
FROM (SELECT Dep_Airport, Arr_Airport, CAST(median(Flight_Duration) AS DOUBLE) AS avg_duration
      FROM flights WHERE Dep_Airport IS NOT NULL AND Arr_Airport IS NOT NULL GROUP BY 1, 2) m
JOIN (SELECT Dep_Airport, Arr_Airport, Distance_type AS distance_type,
             row_number() OVER (PARTITION BY Dep_Airport, Arr_Airport
                                ORDER BY count(*) DESC, Distance_type) AS rk
      FROM flights WHERE Dep_Airport IS NOT NULL AND Arr_Airport IS NOT NULL
        AND Distance_type IS NOT NULL GROUP BY 1, 2, 3) t
  ON m.Dep_Airport = t.Dep_Airport AND m.Arr_Airport = t.Arr_Airport AND t.rk = 1"""))
def q_route_stats(spark, sf):
    return A.route_stats(X.flights(spark, sf))


@query("median_age", W("SELECT CAST(median(Aicraft_age) AS DOUBLE) AS median_age FROM flights"))
def q_median_age(spark, sf):
    return A.median_age(X.flights(spark, sf))


@query("airports_distinct", W("""
SELECT DISTINCT Dep_Airport AS airport FROM flights WHERE Dep_Airport IS NOT NULL ORDER BY 1"""))
def q_airports_distinct(spark, sf):
    return A.airports_distinct(X.flights(spark, sf))


@query("overall_stats", W("""
SELECT count(*) AS total_flights, round(avg(Arr_Delay), 6) AS avg_delay,
       count(DISTINCT Airline) AS airlines, count(DISTINCT Dep_Airport) AS airports FROM clean"""))
def q_overall_stats(spark, sf):
    s = A.overall_stats(X.clean(spark, sf))
    return s.withColumn("avg_delay", r6("avg_delay"))


@query("winsorize_quantile", W(f"""
SELECT {KS}, Arr_Delay,
       round(CASE WHEN Arr_Delay IS NULL THEN NULL ELSE least(greatest(Arr_Delay, q[1]), q[2]) END, 6)
         AS Arr_Delay_clip
FROM clean CROSS JOIN (SELECT quantile_cont(Arr_Delay, [0.02, 0.98]) AS q FROM clean)"""))
def q_winsorize_quantile(spark, sf):
    c = X.clean(spark, sf).select(*KEY, "Arr_Delay")
    w = A.winsorize_quantile(c, "Arr_Delay")
    return w.withColumn("Arr_Delay_clip", r6(F.col("Arr_Delay_clip").cast("double")))


@query("exact_quantiles", """
SELECT p_brand AS brand, quantile_cont(l_extendedprice, 0.02) AS q02, quantile_cont(l_extendedprice, 0.5) AS q50,
       quantile_cont(l_extendedprice, 0.98) AS q98
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
UNION ALL SELECT NULL, quantile_cont(l_extendedprice, 0.02), quantile_cont(l_extendedprice, 0.5),
       quantile_cont(l_extendedprice, 0.98) FROM lineitem""")
def q_exact_quantiles(spark, sf):
    """Quantiles of a continuous column, by brand and over all, by narrowing ranges (the window
    is small so that ranges are narrowed here too)."""
    li, pt = (load_driver_table(spark, sf, n) for n in ("lineitem", "part"))
    by = li.join(pt, li["l_partkey"] == pt["p_partkey"]).select(F.col("p_brand").alias("brand"), "l_extendedprice")
    qs = [0.02, 0.5, 0.98]
    names = [F.col("l_extendedprice")[i].alias(n) for i, n in enumerate(("q02", "q50", "q98"))]
    each = exact_quantiles(by, ["l_extendedprice"], qs, ["brand"], window=5000).select("brand", *names)
    whole = exact_quantiles(li, ["l_extendedprice"], qs, window=5000)
    return each.union(whole.select(F.lit(None).cast("string"), *names))


@query("quantile_filter", W(f"""
SELECT {KS}, round(prcp, 6) AS prcp FROM clean
WHERE prcp <= (SELECT quantile_cont(prcp, 0.99) FROM clean)"""))
def q_quantile_filter(spark, sf):
    c = X.clean(spark, sf).select(*KEY, "prcp")
    return A.quantile_filter(c, "prcp", K.PRCP_Q).withColumn("prcp", r6("prcp"))


# --------------------------------------------------------------------------- 2.5

@query("union_years", W("""
SELECT * FROM flights WHERE year(FlightDate) <= 1998
UNION ALL BY NAME
SELECT * EXCLUDE (Aicraft_age, Tail_Number) FROM flights WHERE year(FlightDate) > 1998"""))
def q_union_years(spark, sf):
    f = X.flights(spark, sf)
    a = f.where(F.year("FlightDate") <= 1998)
    b = f.where(F.year("FlightDate") > 1998).drop("Aicraft_age", "Tail_Number")
    return S.union_parts(a, b)


@query("union_parts", W(f"""
SELECT {KS}, least(greatest(Arr_Delay, -30), 300) AS Arr_Delay FROM flights WHERE Arr_Delay > 15
UNION ALL
SELECT {KS}, greatest(least(greatest(Arr_Delay, -30), 300), 0) AS Arr_Delay FROM flights
WHERE Arr_Delay <= 15"""))
def q_union_parts(spark, sf):
    f = X.flights(spark, sf).select(*KEY, C.clip("Arr_Delay", -30, 300).alias("Arr_Delay"))
    delayed = f.where(F.col("Arr_Delay") > 15)
    ontime = f.where(F.col("Arr_Delay") <= 15).withColumn("Arr_Delay", C.clip("Arr_Delay", lo=0))
    return S.union_parts(delayed, ontime)


# --------------------------------------------------------------------------- 2.6

def _hash_sql(cols: list[str], seed: int = K.SEED) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"md5(concat_ws('|', {parts}, '{seed}'))"


def _bucket_sql(cols: list[str]) -> str:
    return f"(CAST(('0x' || substr({_hash_sql(cols)}, 1, 8)) AS BIGINT) % 10000)"


def _fine_sql(cols: list[str]) -> str:
    return f"CAST(('0x' || substr({_hash_sql(cols)}, 1, 15)) AS BIGINT)"


@query("sample_fraction", W(f"SELECT * FROM flights WHERE {_bucket_sql(KEY)} < 3000"))
def q_sample_fraction(spark, sf):
    return S.sample_fraction(X.flights(spark, sf), 0.30, KEY)


@query("split_train_test", W(f"""
SELECT {KS}, CASE WHEN {_bucket_sql(KEY)} < 8000 THEN 'train' ELSE 'test' END AS split FROM flights"""))
def q_split_train_test(spark, sf):
    f = X.flights(spark, sf).select(*KEY)
    return f.withColumn("split", F.when(S.in_train(KEY, 0.8), "train").otherwise("test"))


@query("split_stratified", W(f"""
SELECT {KS}, delay_label,
       CASE WHEN row_number() OVER (PARTITION BY delay_label ORDER BY {_fine_sql(KEY)}, {KS})
                 <= floor(0.8 * count(*) OVER (PARTITION BY delay_label)) THEN 'train' ELSE 'test' END
         AS split
FROM f_label"""))
def q_split_stratified(spark, sf):
    f = X.f_label(spark, sf).select(*KEY, "delay_label")
    s = S.flag_stratified(f, "delay_label", KEY, 0.8)
    return s.withColumn("split", F.when(F.col("is_train"), "train").otherwise("test")).drop("is_train")


_BAL_D = f"""
SELECT {KS}, least(greatest(Arr_Delay, -30), 300) AS Arr_Delay FROM flights WHERE Arr_Delay IS NOT NULL
"""
_BAL_N = """
SELECT least(floor(sum(CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END) / 2),
             sum(CASE WHEN Arr_Delay <= 15 THEN 1 ELSE 0 END)) AS n FROM bal_d
"""
_BAL_O = f"""
SELECT bal_d.*, row_number() OVER (ORDER BY {_fine_sql(KEY)}, {KS}) AS rk
FROM bal_d WHERE Arr_Delay <= 15
"""


@query("stratified_folds", W(f"""
SELECT {KS}, delay_label, CAST((row_number() OVER (PARTITION BY delay_label
         ORDER BY {_fine_sql(KEY)}, {KS}) - 1) % 3 AS INTEGER) AS fold
FROM f_label"""))
def q_stratified_folds(spark, sf):
    f = X.f_label(spark, sf).select(*KEY, "delay_label")
    return S.stratified_folds(f, "delay_label", KEY, 3)


@query("balanced_sample", W(f"""
SELECT {KS}, Arr_Delay FROM bal_d WHERE Arr_Delay > 15
UNION ALL
SELECT {KS}, greatest(Arr_Delay, 0) AS Arr_Delay FROM bal_o WHERE rk <= (SELECT n FROM bal_n)""",
                            ctes=(("bal_d", _BAL_D), ("bal_n", _BAL_N), ("bal_o", _BAL_O))))
def q_balanced_sample(spark, sf):
    f = X.flights(spark, sf).select(*KEY, "Arr_Delay")
    return S.balanced_sample(f, KEY)


# --------------------------------------------------------------------------- 2.8

@query("etl_clean_enrich", W("""
SELECT * REPLACE (round(tavg, 6) AS tavg, round(prcp, 6) AS prcp, round(wspd, 6) AS wspd,
                  round(pres, 6) AS pres,
                  round(dep_airport_delay_avg, 6) AS dep_airport_delay_avg,
                  round(arr_airport_delay_avg, 6) AS arr_airport_delay_avg)
FROM clean"""))
def q_etl_clean_enrich(spark, sf):
    # the production form: joined rows staged once, statistics in one pass
    c = X.clean(spark, sf)
    rounded = set(K.WEATHER_COLS) | {"dep_airport_delay_avg", "arr_airport_delay_avg"}
    return c.select(*[r6(x).alias(x) if x in rounded else F.col(x) for x in c.columns])

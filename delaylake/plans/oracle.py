"""DuckDB SQL for the domain views, used to build each query's oracle.

The driver registers the raw tables as views; each oracle query is
``WITH <needed views> <body>``. Views are listed in dependency order and only
those a body needs (transitively) are emitted.
"""

from __future__ import annotations

import re

def round_even(expr: str, digits: int) -> str:
    """Half-even rounding of a DOUBLE on its shortest decimal form, as Spark's
    ``bround`` does on doubles (it rounds the value's shortest repr)."""
    return (f"CAST(round_even(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,17)), "
            f"{digits}) AS DOUBLE)")


def avg_round_even(col: str, digits: int = 2, scale: int = 2) -> str:
    """Exact half-even rounding of the mean of a DECIMAL(p, ``scale``) column
    (integer arithmetic, so no double rounding), as a DOUBLE."""
    s = f"CAST(sum({col}) * {10 ** scale} AS HUGEINT)"
    n = f"count({col})"
    step = 10 ** (scale - digits)
    a = f"(abs({s}) // ({n} * {step}))"
    r = f"(abs({s}) % ({n} * {step}))"
    rounded = (f"({a} + CASE WHEN 2 * {r} > {n} * {step} THEN 1 "
               f"WHEN 2 * {r} = {n} * {step} THEN {a} % 2 ELSE 0 END)")
    return f"CAST(sign({s}) * {rounded} AS DOUBLE) / {10 ** digits}"


# name -> (sql, dependencies)
_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    _VIEWS[name] = (sql.strip(), deps)


_ARR = ("CASE WHEN l.l_linenumber = 1 AND l.l_quantity < 5 THEN NULL "
        "ELSE CAST(2 * l.l_linenumber * l.l_quantity - 330 AS INTEGER) END")

view("flights", f"""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag,
       CAST(o.o_orderdate AS DATE) AS FlightDate,
       CAST(isodow(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS Day_Of_Week,
       p.p_brand AS Airline,
       CASE WHEN l.l_suppkey % 10 = 0 THEN NULL ELSE CAST(l.l_suppkey % 10 AS VARCHAR) END AS Tail_Number,
       ns.n_name AS Dep_Airport, nc.n_name AS Arr_Airport,
       o.o_orderpriority AS DepTime_label, p.p_type AS Distance_type,
       CAST(floor(l.l_extendedprice / 1000) AS INTEGER) AS Flight_Duration,
       {_ARR} - l.l_linenumber AS Dep_Delay,
       {_ARR} AS Arr_Delay,
       CASE WHEN p.p_size > 45 THEN NULL ELSE p.p_size END AS Aicraft_age
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation ns ON s.s_nationkey = ns.n_nationkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation nc ON c.c_nationkey = nc.n_nationkey
""")

view("weather", """
SELECT CAST(o.o_orderdate AS DATE) AS time, n.n_name AS airport_id,
       CAST(max(o.o_totalprice) / 10000 - 10 AS DECIMAL(10,2)) AS tavg,
       CASE WHEN min(o.o_custkey) % 7 = 0 THEN NULL
            ELSE CAST(min(o.o_totalprice) / 20000 AS DECIMAL(10,2)) END AS prcp,
       CAST(count(*) AS DECIMAL(10,2)) AS wspd,
       CAST(1000 + max(o.o_custkey) % 40 AS DECIMAL(10,2)) AS pres
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
""")

view("cancelled", """
SELECT FlightDate, Airline, Tail_Number FROM flights
WHERE l_returnflag = 'R' AND l_linenumber = 7
""", ("flights",))

view("airports", """
SELECT n_name AS IATA_CODE, CAST(25 + n_nationkey AS DOUBLE) AS LATITUDE,
       CAST(-120 + 2 * n_nationkey AS DOUBLE) AS LONGITUDE
FROM nation
""")

view("requests", """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                 CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS request_id,
       Airline AS airline_key,
       CASE WHEN l_orderkey % 13 = 0 THEN '?' || Dep_Airport ELSE Dep_Airport END AS dep_airport,
       CASE WHEN l_orderkey % 13 = 0 THEN '?' || Arr_Airport ELSE Arr_Airport END AS arr_airport,
       strftime(FlightDate, '%Y-%m-%d') AS travel_date, DepTime_label AS dep_time
FROM flights
""", ("flights",))

view("plog", """
SELECT event_id, ts AS "timestamp", event_type AS source,
       least(value / 500, 1.0) AS delay_prob
FROM events
""")

view("log_t", f"""
SELECT event_id, "timestamp", source,
       {round_even("delay_prob * 100", 1)} AS delay_prob,
       {round_even("(1 - delay_prob) * 100", 1)} AS on_time_prob,
       CASE WHEN delay_prob >= 0.40 THEN 'DELAYED' WHEN delay_prob >= 0.25 THEN 'POSSIBLY DELAYED'
            WHEN delay_prob IS NOT NULL THEN 'ON TIME' END AS prediction,
       CASE WHEN delay_prob >= 0.40 THEN 'high' WHEN delay_prob >= 0.25 THEN 'medium'
            WHEN delay_prob IS NOT NULL THEN 'low' END AS risk,
       CAST(NULL AS VARCHAR) AS airline, CAST(NULL AS VARCHAR) AS dep_airport,
       CAST(NULL AS VARCHAR) AS arr_airport, CAST(NULL AS VARCHAR) AS route,
       CAST(NULL AS VARCHAR) AS travel_date, CAST(NULL AS VARCHAR) AS dep_time,
       CAST(NULL AS VARCHAR) AS model_used
FROM plog
""", ("plog",))

# Flights after the cancel anti join (null key parts never match).
view("f_anti", """
SELECT * FROM flights f WHERE NOT EXISTS (
  SELECT 1 FROM cancelled c
  WHERE c.FlightDate = f.FlightDate AND c.Airline = f.Airline AND c.Tail_Number = f.Tail_Number)
""", ("flights", "cancelled"))

view("f_joined", """
SELECT fd.*, a.LATITUDE, a.LONGITUDE, w.tavg, w.prcp, w.wspd, w.pres
FROM (SELECT DISTINCT * FROM f_anti) fd
LEFT JOIN airports a ON fd.Dep_Airport = a.IATA_CODE
LEFT JOIN weather w ON fd.Dep_Airport = w.airport_id AND fd.FlightDate = w.time
""", ("f_anti", "airports", "weather"))

view("f_filled", """
SELECT fj.* EXCLUDE (Day_Of_Week) REPLACE (
         coalesce(CAST(fj.tavg AS DOUBLE), m.m_tavg) AS tavg,
         coalesce(CAST(fj.prcp AS DOUBLE), m.m_prcp) AS prcp,
         coalesce(CAST(fj.wspd AS DOUBLE), m.m_wspd) AS wspd,
         coalesce(CAST(fj.pres AS DOUBLE), m.m_pres) AS pres,
         coalesce(fj.Dep_Delay, 0) AS Dep_Delay,
         coalesce(fj.Arr_Delay, 0) AS Arr_Delay,
         coalesce(fj.DepTime_label, 'Unknown') AS DepTime_label,
         coalesce(fj.Distance_type, 'Unknown') AS Distance_type),
       CAST(year(fj.FlightDate) AS INTEGER) AS year,
       CAST(month(fj.FlightDate) AS INTEGER) AS month,
       CAST(dayofweek(fj.FlightDate) + 1 AS INTEGER) AS day_of_week,
       CASE WHEN coalesce(fj.Arr_Delay, 0) > 15 THEN 1 ELSE 0 END AS delay_label
FROM f_joined fj CROSS JOIN (
  SELECT CAST(sum(tavg) AS DOUBLE) / count(tavg) AS m_tavg,
         CAST(sum(prcp) AS DOUBLE) / count(prcp) AS m_prcp,
         CAST(sum(wspd) AS DOUBLE) / count(wspd) AS m_wspd,
         CAST(sum(pres) AS DOUBLE) / count(pres) AS m_pres
  FROM f_joined) m
""", ("f_joined",))

view("clean", """
SELECT ff.*, dr.dep_airport_delay_avg, ar.arr_airport_delay_avg
FROM f_filled ff
LEFT JOIN (SELECT Dep_Airport, avg(delay_label) AS dep_airport_delay_avg
           FROM f_filled GROUP BY 1) dr ON ff.Dep_Airport = dr.Dep_Airport
LEFT JOIN (SELECT Arr_Airport, avg(delay_label) AS arr_airport_delay_avg
           FROM f_filled GROUP BY 1) ar ON ff.Arr_Airport = ar.Arr_Airport
""", ("f_filled",))

# Flights with a raw 0/1 label (no fills) for the label-only operators.
view("f_label", """
SELECT *, CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END AS delay_label FROM flights
""", ("flights",))

view("f_weather", """
SELECT f.*, w.tavg, w.prcp, w.wspd, w.pres
FROM flights f LEFT JOIN weather w ON f.Dep_Airport = w.airport_id AND f.FlightDate = w.time
""", ("flights", "weather"))


def _needed(body: str, extra: tuple[str, ...] = ()) -> list[str]:
    found: set[str] = set(extra)
    for name in _VIEWS:
        if re.search(rf"\b{name}\b", body):
            found.add(name)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _VIEWS[n][1]:
            visit(d)
        order.append(n)

    for name in _VIEWS:          # definition order is dependency order
        if name in found:
            visit(name)
    return order


def with_views(body: str, *extra_views: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH`` clause of the views ``body`` (and ``ctes``) reference, then ``body``.

    ``ctes`` are query-local (name, sql) pairs appended after the shared views.
    """
    text = body + " " + " ".join(s for _, s in ctes)
    names = _needed(text, extra_views)
    parts = [f"{n} AS (\n{_VIEWS[n][0]}\n)" for n in names]
    parts += [f"{n} AS (\n{s.strip()}\n)" for n, s in ctes]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

"""Joins and lookups.

Sizing rule used throughout: a side is broadcast explicitly only when its size
is checked (``sized``) or fixed (one-row aggregates). Any side whose size grows
with the data (weather, rates, cancelled keys) is joined with a plain
equi-join; AQE measures it at runtime and turns the join into a broadcast hash join when it is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, else keeps the sort-merge
join and splits skewed partitions (``spark.sql.adaptive.skewJoin``). A hub
airport holding a third of all flights is therefore split across tasks on the
big side instead of landing in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators.aggregates import delay_rate
from delaylake.session import materialize, sized


def cancel_anti_join(flights: DataFrame, cancelled: DataFrame,
                     keys: Sequence[str] = tuple(K.CANCEL_KEYS),
                     null_safe: bool = False) -> DataFrame:
    """Remove flights whose key appears in ``cancelled``.

    The key is the aircraft-day (date, airline, tail): every flight of that
    tail on that day goes. With ``null_safe=False`` (Spark semantics) a null key
    part never matches, so such flights stay; with ``null_safe=True`` (merge
    semantics) null matches null and those flights are removed.

    The cancelled side is first reduced to its distinct keys (partial
    aggregation map-side), which bounds it by the key space rather than by the
    number of cancelled rows and keeps duplicate cancelled rows from mattering.
    It is written once and broadcast while it is small (:func:`lookup_side`), so
    that the flights are not exchanged. When that key set is too large to broadcast, the anti join is a sort-merge
    join and a hot flight key (e.g. a missing tail number on a third of all
    flights, which all hash alike) is a skewed left partition: AQE's skew-join
    rule splits it across tasks (left-anti joins split on the left side).
    """
    keys = list(keys)
    ck = lookup_side(cancelled.select(*keys).dropDuplicates(), "cancelled-keys")
    if not null_safe:
        return flights.join(ck, keys, "left_anti")
    ren = ck.select(*[F.col(k).alias(f"__c_{k}") for k in keys])
    cond = None
    for k in keys:
        e = flights[k].eqNullSafe(ren[f"__c_{k}"])
        cond = e if cond is None else cond & e
    return flights.join(ren, cond, "left_anti")


def join_airport_coords(flights: DataFrame, airports: DataFrame, key: str = "Dep_Airport",
                        code: str = "IATA_CODE") -> DataFrame:
    """Attach LATITUDE / LONGITUDE of the departure airport (left join).

    The airports are made unique on the code first (deterministically), so the
    join can never multiply flights, and are broadcast only after their size is
    checked (:func:`sized`).
    """
    a = unique_on(airports.select(F.col(code).alias(key), "LATITUDE", "LONGITUDE"), [key])
    return flights.join(sized(a), key, "left")


def lookup_side(lookup: DataFrame, name: str) -> DataFrame:
    """The small side of a join, written once so that it is computed once, and
    broadcast if it is small (:func:`sized`): the flights then stay where they
    are, whatever the planner would have guessed of its size. A session that has
    turned size-based broadcasts off (a negative threshold) gets none here."""
    if lookup.isStreaming:
        return lookup
    stored = materialize(lookup, name)
    off = lookup.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return stored if off else sized(stored)


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen deterministically (smallest remaining values).

    Guards a lookup join against duplicate keys that would multiply the other
    side. Partial aggregation keeps the shuffle to one row per key per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
    return picked.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def join_daily_weather(flights: DataFrame, weather: DataFrame,
                       on: tuple[str, str] = ("Dep_Airport", "FlightDate"),
                       weather_keys: tuple[str, str] = ("airport_id", "time"),
                       dedupe: bool = True) -> DataFrame:
    """Left join of each flight to the weather of its departure airport and day.

    Weather has one row per (airport, day); ``dedupe`` enforces that so the
    join cannot multiply flights. It is written once and broadcast while it is
    small (:func:`lookup_side`). The right-hand key columns are dropped.
    """
    w = unique_on(weather, list(weather_keys)) if dedupe else weather
    w = lookup_side(w, "daily-weather")
    w = w.withColumnRenamed(weather_keys[0], on[0]).withColumnRenamed(weather_keys[1], on[1])
    return flights.join(w, list(on), "left")


def join_target_rates(flights: DataFrame, rates_source: DataFrame | None = None,
                      label: str = "delay_label") -> DataFrame:
    """Attach dep_airport_delay_avg and arr_airport_delay_avg.

    Rates come from ``rates_source`` (default: the same rows, as the
    reference does; pass the training split to avoid target leakage). Each
    rate table is an aggregate (partial aggregation, one row per airport) joined
    back on its key: no window, so a hub airport is never gathered in one task.
    The tables are written first: their size is then known, and a small one is
    broadcast instead of shuffling the flights on a few airports.
    """
    src = flights if rates_source is None else rates_source
    dep = materialize(delay_rate(src, "Dep_Airport", label, "dep_airport_delay_avg"), "dep-rate")
    arr = materialize(delay_rate(src, "Arr_Airport", label, "arr_airport_delay_avg"), "arr-rate")
    return flights.join(dep, "Dep_Airport", "left").join(arr, "Arr_Airport", "left")


def lookup_weather_default(req: DataFrame, weather_avg: DataFrame,
                           airport_col: str = "dep_airport", month_col: str = "req_month",
                           defaults: dict | None = None) -> DataFrame:
    """(airport, month) -> tavg, prcp, wspd, pres; misses get the defaults."""
    defaults = K.DEFAULT_WEATHER if defaults is None else defaults
    w = unique_on(weather_avg.select(
        F.col("airport_id").alias("__w_airport"), F.col("month").alias("__w_month"),
        *[F.col(c).cast("double").alias(f"__w_{c}") for c in K.WEATHER_COLS]),
        ["__w_airport", "__w_month"])
    w = materialize(w, "weather-lookup")
    j = req.join(w, (req[airport_col] == w["__w_airport"]) & (req[month_col] == w["__w_month"]),
                 "left")
    return j.select(*req.columns,
                    *[F.coalesce(F.col(f"__w_{c}"), F.lit(float(defaults[c]))).alias(c)
                      for c in K.WEATHER_COLS])


def lookup_coords_default(req: DataFrame, coords: DataFrame, airport_col: str = "dep_airport",
                          default: tuple[float, float] = K.DEFAULT_DEP_COORDS,
                          prefix: str = "") -> DataFrame:
    """airport -> LATITUDE, LONGITUDE; unknown airports get ``default``.

    The coordinates are unique per airport code, broadcast if small enough."""
    c = unique_on(coords.select(F.col("IATA_CODE").alias("__k"),
                                F.col("LATITUDE").alias("__lat"), F.col("LONGITUDE").alias("__lon")),
                  ["__k"])
    j = req.join(sized(c), req[airport_col] == c["__k"], "left")
    return j.select(*req.columns,
                    F.coalesce("__lat", F.lit(float(default[0]))).alias(f"{prefix}LATITUDE"),
                    F.coalesce("__lon", F.lit(float(default[1]))).alias(f"{prefix}LONGITUDE"))


def lookup_delay_default(req: DataFrame, rates: DataFrame, rate_key: str = "Dep_Airport",
                         rate_col: str = "dep_airport_delay_avg",
                         dep_col: str = "dep_airport", arr_col: str = "arr_airport",
                         default: float = K.DEFAULT_DELAY_RATE) -> DataFrame:
    """Departure and arrival rates from one airport -> rate table; misses 0.20."""
    r = unique_on(rates.select(F.col(rate_key).alias("__k"), F.col(rate_col).alias("__r")), ["__k"])
    r = materialize(r, "rate-lookup")
    rd = r.select(F.col("__k").alias("__kd"), F.col("__r").alias("__rd"))
    ra = r.select(F.col("__k").alias("__ka"), F.col("__r").alias("__ra"))
    j = (req.join(rd, req[dep_col] == rd["__kd"], "left")
            .join(ra, req[arr_col] == ra["__ka"], "left"))
    return j.select(*req.columns,
                    F.coalesce("__rd", F.lit(default)).alias("dep_airport_delay_avg"),
                    F.coalesce("__ra", F.lit(default)).alias("arr_airport_delay_avg"))


def route_estimate(req: DataFrame, coords: DataFrame, dep_col: str = "dep_airport",
                   arr_col: str = "arr_airport") -> DataFrame:
    """Straight-line route estimate from the two airports' coordinates.

    distance = 69 * sqrt(dlat^2 + dlon^2) (degrees, not great-circle, as in the
    reference); duration = max(30, floor(distance / 8)); haul type by the cuts
    800 / 1500 with the reference's labels kept verbatim. Unknown departure
    falls back to (39, -98), unknown arrival to (41.9, -87.9).
    """
    c = unique_on(coords.select(F.col("IATA_CODE").alias("__k"),
                                F.col("LATITUDE").alias("__lat"), F.col("LONGITUDE").alias("__lon")),
                  ["__k"])
    c = sized(c)
    cd = c.select(F.col("__k").alias("__kd"), F.col("__lat").alias("__dlat"),
                  F.col("__lon").alias("__dlon"))
    ca = c.select(F.col("__k").alias("__ka"), F.col("__lat").alias("__alat"),
                  F.col("__lon").alias("__alon"))
    j = (req.join(cd, req[dep_col] == cd["__kd"], "left")
            .join(ca, req[arr_col] == ca["__ka"], "left"))
    dlat = F.coalesce("__dlat", F.lit(K.DEFAULT_DEP_COORDS[0]))
    dlon = F.coalesce("__dlon", F.lit(K.DEFAULT_DEP_COORDS[1]))
    alat = F.coalesce("__alat", F.lit(K.DEFAULT_ARR_COORDS[0]))
    alon = F.coalesce("__alon", F.lit(K.DEFAULT_ARR_COORDS[1]))
    dist = F.sqrt(F.pow(F.abs(dlat - alat), 2) + F.pow(F.abs(dlon - alon), 2)) * K.MILES_PER_DEGREE
    dur = F.greatest(F.lit(K.MIN_DURATION_MIN),
                     F.floor(dist / K.MILES_PER_MINUTE).cast("int"))
    haul = (F.when(dist < K.HAUL_CUTS[0], F.lit(K.HAUL_LABELS[0]))
             .when(dist < K.HAUL_CUTS[1], F.lit(K.HAUL_LABELS[1]))
             .otherwise(F.lit(K.HAUL_LABELS[2])))
    return j.select(*req.columns, dist.alias("est_distance"), dur.alias("flight_duration"),
                    haul.alias("route_type"))


def autofill(req: DataFrame, weather_avg: DataFrame, coords: DataFrame) -> DataFrame:
    """Everything the request form fills in, for a DataFrame of requests.

    Adds day name, weekend Yes/No, estimated duration and haul type, the
    month's weather rounded to 2 decimals (half-even) and aircraft age 12.
    """
    from delaylake.operators.projection import parse_travel_date

    p = parse_travel_date(req)
    w = lookup_weather_default(p, weather_avg)
    r = route_estimate(w, coords)
    return r.select(
        *req.columns,
        F.col("req_day_name").alias("day_of_week"),
        F.when(F.col("req_is_weekend"), F.lit("Yes")).otherwise(F.lit("No")).alias("is_weekend"),
        "flight_duration", "route_type",
        *[F.bround(F.col(c), 2).alias(c) for c in K.WEATHER_COLS],
        F.lit(K.DEFAULT_AIRCRAFT_AGE).alias("aircraft_age"),
    )

"""Domain views over the driver's star-schema tables.

The reference reads flight, weather, cancellation and airport CSVs that are not
shipped. The same shapes are derived here from the driver's parquet tables
(mapping fixed in FIXTURES.md §2) so every operator runs on data that grows
with the scale factor:

flights    one row per lineitem: lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ customer,
           airports are the supplier / customer nation names
weather    one row per (customer nation, order date)
cancelled  the flight keys of a fixed slice of flights
airports   nation-derived coordinates (at most 25 rows: the nation table is fixed)
requests   scoring requests taken from flights
log        prediction-log rows taken from ``events``

Plan notes (100 TB): the fact stream is exchanged twice, by part and by order.
Suppliers are broadcast while they are few (``session.sized``), customers are
joined to the orders, and airports move as nation keys. The order comes last,
so that the flights leave dealt by order, at most about ``ROWS_PER_TASK`` to a
task: full-row duplicates are then dropped without an exchange and without
spilling. AQE turns the other joins into broadcasts only after measuring a side,
and splits a hot part. Only the columns below are read from each scan (column
pruning reaches ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.session import scratch_path, sized
from delaylake.sources.tables import load_driver_table

ROWS_PER_TASK = 200_000     # flights in a task that groups whole rows: about 64 MB of them
FLIGHT_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_driver_table(spark, sf_dir, name)


def flight_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the flights are dealt over, by order."""
    return max(spark.sparkContext.defaultParallelism, -(-_t(spark, sf_dir, "lineitem").count() // ROWS_PER_TASK))


def flights(spark: SparkSession, sf_dir: str, keep_key: bool = True) -> DataFrame:
    """Flights with the reference's column names (see FIXTURES.md §2)."""
    li = _t(spark, sf_dir, "lineitem")
    arr_delay = (2 * F.col("l_linenumber") * F.col("l_quantity") - 330).cast("int")
    arr_delay = F.when((F.col("l_linenumber") == 1) & (F.col("l_quantity") < 5),
                       F.lit(None).cast("int")).otherwise(arr_delay)
    # What can be computed from a line alone is computed before it moves: small
    # whole numbers are exchanged instead of prices and quantities.
    li = li.select(*FLIGHT_KEY, "l_returnflag", arr_delay.alias("Arr_Delay"),
                   F.floor(F.col("l_extendedprice") / 1000).cast("int").alias("Flight_Duration"))
    o = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("FlightDate"), "o_orderpriority")
    p = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
    # Airports move as nation keys; the names (a fixed 25-row bound, broadcast)
    # are attached to the joined rows.
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dep = F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                    F.col("n_name").alias("Dep_Airport")))
    arr = F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                    F.col("n_name").alias("Arr_Airport")))
    s = sized(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"))
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")

    # The join on the order comes last: the flights are then dealt by order, and
    # what groups them by a key that holds the order needs no further exchange.
    # The number of tasks follows the rows, so that whole rows can be grouped in
    # a task's memory (packed shuffle blocks would hold five times as many).
    tasks = flight_tasks(spark, sf_dir)
    j = (li.join(s, "l_suppkey")
           .join(p, "l_partkey")
           .repartition(tasks, "l_orderkey")
           .join(o.join(c, "o_custkey").drop("o_custkey"), "l_orderkey")
           .join(dep, "s_nationkey").join(arr, "c_nationkey"))

    flight_date = F.col("FlightDate")
    tail = F.col("l_suppkey") % 10
    cols: list[Column] = [
        flight_date,
        (F.weekday(flight_date) + 1).alias("Day_Of_Week"),
        F.col("p_brand").alias("Airline"),
        F.when(tail == 0, F.lit(None).cast("string")).otherwise(tail.cast("string"))
         .alias("Tail_Number"),
        "Dep_Airport",
        "Arr_Airport",
        F.col("o_orderpriority").alias("DepTime_label"),
        F.col("p_type").alias("Distance_type"),
        "Flight_Duration",
        (F.col("Arr_Delay") - F.col("l_linenumber")).alias("Dep_Delay"),
        "Arr_Delay",
        F.when(F.col("p_size") > 45, F.lit(None).cast("int")).otherwise(F.col("p_size"))
         .alias("Aicraft_age"),
    ]
    if keep_key:
        cols = FLIGHT_KEY + ["l_returnflag"] + cols
    return j.select(*cols)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather per (airport, day), one row per pair.

    A grouped aggregate over orders ⋈ customer: partial aggregation runs
    map-side, so only one row per (nation, day, task) is shuffled.
    """
    o = _t(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("time"), "o_totalprice")
    n = F.broadcast(_t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("airport_id")))
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    g = (o.join(c, "o_custkey").join(n, "c_nationkey")
          .groupBy("airport_id", "time")
          .agg(F.max("o_totalprice").alias("_maxp"), F.min("o_totalprice").alias("_minp"),
               F.count(F.lit(1)).alias("_n"), F.min("o_custkey").alias("_minc"),
               F.max("o_custkey").alias("_maxc")))
    dec = "decimal(10,2)"
    return g.select(
        "time", "airport_id",
        (F.col("_maxp") / 10000 - 10).cast(dec).alias("tavg"),
        F.when(F.col("_minc") % 7 == 0, F.lit(None).cast(dec))
         .otherwise((F.col("_minp") / 20000).cast(dec)).alias("prcp"),
        F.col("_n").cast(dec).alias("wspd"),
        (1000 + F.col("_maxc") % 40).cast(dec).alias("pres"),
    )


def stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights written once for several readers, in buckets by order: duplicates are then
    found without an exchange, as on :func:`flights` itself."""
    buckets = max(flight_tasks(spark, sf_dir), int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "flights")
    name = "flights_" + path.rsplit("-", 1)[1]
    (flights(spark, sf_dir).write.format("parquet").option("path", path)
     .bucketBy(buckets, "l_orderkey").saveAsTable(name))
    return spark.table(name)


def cancelled(spark: SparkSession, sf_dir: str, f: DataFrame | None = None) -> DataFrame:
    f = flights(spark, sf_dir) if f is None else f
    return (f.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7))
             .select("FlightDate", "Airline", "Tail_Number"))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport coordinates; at most 25 rows (bounded by the nation table)."""
    n = _t(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("IATA_CODE"),
                    (25 + F.col("n_nationkey")).cast("double").alias("LATITUDE"),
                    (-120 + 2 * F.col("n_nationkey")).cast("double").alias("LONGITUDE"))


def request_id(prefix: str = "") -> Column:
    return F.concat_ws("-", *[F.col(prefix + k).cast("string") for k in FLIGHT_KEY])


def request_airport(col: str) -> Column:
    """Airport of a request: every 13th order asks for one that no table knows."""
    return F.when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit("?"), F.col(col))).otherwise(F.col(col))


def requests(spark: SparkSession, sf_dir: str, f: DataFrame | None = None) -> DataFrame:
    """Scoring requests: one per flight."""
    f = flights(spark, sf_dir) if f is None else f
    return f.select(
        request_id().alias("request_id"),
        F.col("Airline").alias("airline_key"),
        request_airport("Dep_Airport").alias("dep_airport"),
        request_airport("Arr_Airport").alias("arr_airport"),
        F.date_format("FlightDate", "yyyy-MM-dd").alias("travel_date"),
        F.col("DepTime_label").alias("dep_time"))


def prediction_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-log rows derived from ``events``."""
    e = _t(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("source"),
        F.least(F.col("value") / 500, F.lit(1.0)).alias("delay_prob"),
    )

"""Spark-side inputs of the registered queries (twins of ``plans.oracle`` views)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.operators import joins
from delaylake.plans.etl import etl_clean_enrich, labelled_rows
from delaylake.session import path_exists
from delaylake.sources import views as V

flights = V.flights
weather = V.weather
cancelled = V.cancelled
airports = V.airports
requests = V.requests
plog = V.prediction_log_view

# Priority of the order -> departure slot of the heatmap (Night has two).
SLOT_OF_PRIORITY = {
    "1-URGENT": "Morning",
    "2-HIGH": "Afternoon",
    "3-MEDIUM": "Evening",
    "4-NOT SPECIFIED": "Night",
    "5-LOW": "Night",
}


_CLEAN: dict[tuple[str, str], DataFrame] = {}
_FLIGHTS: dict[tuple[str, str], DataFrame] = {}


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """The flights that this application has written for this input folder, if any."""
    f = _FLIGHTS.get((spark.sparkContext.applicationId, sf_dir))
    return f if f is not None and all(path_exists(spark, x) for x in f.inputFiles()[:1]) else None


def shared_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights, written once per application and input folder: for queries that use them
    beside the clean table, which then reads them too."""
    f = _stored(spark, sf_dir)
    if f is None:
        f = _FLIGHTS[spark.sparkContext.applicationId, sf_dir] = V.stored_flights(spark, sf_dir)
    return f


def clean(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    """The whole ETL over whole tables (no sampling).

    ``stage=True`` (default) is the production form: the joined rows and their
    statistics are written once per application and input folder, under the
    shared checkpoint folder; every query of that folder plans its fills and
    rates lazily over those files and reads only the columns it needs.
    ``stage=False`` returns the lazy composed plan (used to check both forms
    agree).
    """
    def build(staged: bool) -> DataFrame:
        f = _stored(spark, sf_dir) if staged else None
        return etl_clean_enrich(flights(spark, sf_dir) if f is None else f, V.cancelled(spark, sf_dir, f),
                                airports(spark, sf_dir), weather(spark, sf_dir), stage=staged)

    if not stage:
        return build(False)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CLEAN or not all(path_exists(spark, f) for f in _CLEAN[key].inputFiles()[:1]):
        _CLEAN[key] = build(True)
    return _CLEAN[key]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the clean table with airports and label only (see
    ``etl.labelled_rows``)."""
    return labelled_rows(flights(spark, sf_dir), cancelled(spark, sf_dir))


def f_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flights(spark, sf_dir)
    return f.withColumn("delay_label", C.delay_label("Arr_Delay"))


def f_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_daily_weather(flights(spark, sf_dir), weather(spark, sf_dir), dedupe=False)


def slot_label(col: str = "DepTime_label") -> F.Column:
    m = F.create_map(*[F.lit(x) for kv in SLOT_OF_PRIORITY.items() for x in kv])
    return F.try_element_at(m, F.col(col))


SLOT_SQL = ("CASE DepTime_label WHEN '1-URGENT' THEN 'Morning' WHEN '2-HIGH' THEN 'Afternoon' "
            "WHEN '3-MEDIUM' THEN 'Evening' WHEN '4-NOT SPECIFIED' THEN 'Night' "
            "WHEN '5-LOW' THEN 'Night' END")


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-log rows in the log schema: probabilities as percents, risk
    and verdict from the bracket; fields the events do not carry are null."""
    p = plog(spark, sf_dir)
    rb = C.risk_bracket("delay_prob")
    pct, on_time = C.percent_fields("delay_prob")
    return p.select(
        "event_id", "timestamp", "source",
        pct.alias("delay_prob"), on_time.alias("on_time_prob"),
        rb["label"].alias("prediction"), rb["risk"].alias("risk"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("airline", "dep_airport", "arr_airport", "route", "travel_date", "dep_time",
           "model_used")],
    )


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request dates as text, with the malformed forms a form can send:
    month 13, empty, missing, non-numeric. Derived from the flights."""
    f = flights(spark, sf_dir)
    good = F.date_format("FlightDate", "yyyy-MM-dd")
    txt = (F.when(F.col("l_linenumber") == 2, F.concat(F.year("FlightDate").cast("string"),
                                                       F.lit("-13-45")))
            .when(F.col("l_linenumber") == 3, F.lit(""))
            .when(F.col("l_linenumber") == 4, F.lit(None).cast("string"))
            .when(F.col("l_linenumber") == 5, F.concat(F.lit("x"), good))
            .otherwise(good))
    return f.select(*V.FLIGHT_KEY, txt.alias("travel_date"))


DATE_TEXTS_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_linenumber = 2 THEN CAST(year(FlightDate) AS VARCHAR) || '-13-45'
            WHEN l_linenumber = 3 THEN ''
            WHEN l_linenumber = 4 THEN NULL
            WHEN l_linenumber = 5 THEN 'x' || strftime(FlightDate, '%Y-%m-%d')
            ELSE strftime(FlightDate, '%Y-%m-%d') END AS travel_date
FROM flights
"""

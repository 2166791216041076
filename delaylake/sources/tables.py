"""Readers, writers and fixed schemas.

All readers are lazy: they return a DataFrame whose scan Catalyst prunes to
the columns and predicates the downstream plan needs (Parquet shows
``PushedFilters`` / ``ReadSchema``). CSV is always read with an explicit
schema so no inference job scans the file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylake.session import materialize
from delaylake.sources.publish import current, publish, publish_table

# Tables the driver ships (one parquet file each under an sf directory).
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# --- schemas of the source data the operators are written for --------------

FLIGHTS_SCHEMA = T.StructType([
    T.StructField("FlightDate", T.StringType()),
    T.StructField("Day_Of_Week", T.IntegerType()),
    T.StructField("Airline", T.StringType()),
    T.StructField("Tail_Number", T.StringType()),
    T.StructField("Dep_Airport", T.StringType()),
    T.StructField("Arr_Airport", T.StringType()),
    T.StructField("Dep_CityName", T.StringType()),
    T.StructField("Arr_CityName", T.StringType()),
    T.StructField("DepTime_label", T.StringType()),
    T.StructField("Distance_type", T.StringType()),
    T.StructField("Flight_Duration", T.IntegerType()),
    T.StructField("Dep_Delay", T.IntegerType()),
    T.StructField("Dep_Delay_Tag", T.IntegerType()),
    T.StructField("Dep_Delay_Type", T.StringType()),
    T.StructField("Arr_Delay", T.IntegerType()),
    T.StructField("Arr_Delay_Type", T.StringType()),
    T.StructField("Delay_Carrier", T.IntegerType()),
    T.StructField("Delay_Weather", T.IntegerType()),
    T.StructField("Delay_NAS", T.IntegerType()),
    T.StructField("Delay_Security", T.IntegerType()),
    T.StructField("Delay_LastAircraft", T.IntegerType()),
    T.StructField("Manufacturer", T.StringType()),
    T.StructField("Model", T.StringType()),
    T.StructField("Aicraft_age", T.IntegerType()),
])

WEATHER_SCHEMA = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("tavg", T.DoubleType()),
    T.StructField("tmin", T.DoubleType()),
    T.StructField("tmax", T.DoubleType()),
    T.StructField("prcp", T.DoubleType()),
    T.StructField("snow", T.DoubleType()),
    T.StructField("wdir", T.DoubleType()),
    T.StructField("wspd", T.DoubleType()),
    T.StructField("wpgt", T.DoubleType()),
    T.StructField("pres", T.DoubleType()),
    T.StructField("tsun", T.DoubleType()),
    T.StructField("airport_id", T.StringType()),
])

CANCELLED_SCHEMA = T.StructType([
    T.StructField("FlightDate", T.StringType()),
    T.StructField("Airline", T.StringType()),
    T.StructField("Tail_Number", T.StringType()),
])

AIRPORTS_SCHEMA = T.StructType([
    T.StructField("IATA_CODE", T.StringType()),
    T.StructField("AIRPORT", T.StringType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("COUNTRY", T.StringType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
])

COORDS_SCHEMA = T.StructType([
    T.StructField("IATA_CODE", T.StringType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
])

DELAY_LOOKUP_SCHEMA = T.StructType([
    T.StructField("Dep_Airport", T.StringType()),
    T.StructField("dep_airport_delay_avg", T.DoubleType()),
])

WEATHER_AVG_SCHEMA = T.StructType([
    T.StructField("airport_id", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("tavg", T.DoubleType()),
    T.StructField("prcp", T.DoubleType()),
    T.StructField("wspd", T.DoubleType()),
    T.StructField("pres", T.DoubleType()),
])

WEATHER_STRUCT = T.StructType([
    T.StructField("tavg", T.DoubleType()),
    T.StructField("prcp", T.DoubleType()),
    T.StructField("wspd", T.DoubleType()),
    T.StructField("pres", T.DoubleType()),
])

PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("airline", T.StringType()),
    T.StructField("dep_airport", T.StringType()),
    T.StructField("arr_airport", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("travel_date", T.StringType()),
    T.StructField("dep_time", T.StringType()),
    T.StructField("delay_prob", T.DoubleType()),
    T.StructField("on_time_prob", T.DoubleType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("risk", T.StringType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("flight_duration", T.IntegerType()),
    T.StructField("route_type", T.StringType()),
    T.StructField("weather", WEATHER_STRUCT),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("airline_key", T.StringType()),
    T.StructField("dep_airport", T.StringType()),
    T.StructField("arr_airport", T.StringType()),
    T.StructField("travel_date", T.StringType()),
    T.StructField("dep_time", T.StringType()),
])


# --- readers ------------------------------------------------------------------

REJECTED = "_rejected"


def csv_header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names of a CSV input: the first line of its first file, trimmed,
    without a byte order mark."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"no header line in {path}")
    cells = next(csv.reader([first[0][0]]))
    return [c.strip().removeprefix("\ufeff").strip() for c in cells]


def read_csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   columns: Iterable[str] | None = None, rejected: bool = False) -> DataFrame:
    """Typed CSV read with a header, columns matched by name.

    The header's names (blanks around them and a byte order mark dropped) are
    mapped to ``schema``: any order and any further columns are fine, a column
    the header lacks raises ValueError. All files of one call must have the same
    header; Spark checks each and raises otherwise. Cell values are trimmed. A row
    with a bad cell or a wrong number of cells keeps the cells that parse;
    ``rejected`` adds the column ``_rejected`` with such a row's text (null for
    good rows), and :func:`csv_rejects` returns those rows alone.
    """
    names = csv_header(spark, path)
    wanted = list(schema.fieldNames() if columns is None else columns)
    known = {f.name.lower(): f for f in schema.fields}
    have = {n.lower() for n in names}
    missing = [c for c in wanted if c.lower() not in have]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {names}")
    fields = [T.StructField(n, known[n.lower()].dataType if n.lower() in known else T.StringType())
              for n in names]
    df = (spark.read
          .schema(T.StructType([*fields, T.StructField(REJECTED, T.StringType())]))
          .option("header", True)
          .option("enforceSchema", False)
          .option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", REJECTED)
          .csv(path))
    out = [F.col(f"`{c}`").alias(c) for c in wanted]
    return df.select(*out, *[REJECTED] * rejected)


def csv_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of a CSV input that do not parse into ``schema``, with their text in
    ``_rejected``, written under the shared checkpoint folder (Spark does not
    count a raw CSV's rejects alone)."""
    df = read_csv_table(spark, path, schema, rejected=True)
    return materialize(df.where(F.col(REJECTED).isNotNull()), "csv-rejects")


def read_parquet_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def _json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, multi_line: bool,
          rejected: bool) -> DataFrame:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField(REJECTED, T.StringType())])
    df = (spark.read.schema(whole).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", REJECTED).json(path))
    return df if rejected else df.drop(REJECTED)


def read_json_records(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                      rejected: bool = False) -> DataFrame:
    """Records stored as JSON lines. A line that is no record of the schema keeps the fields that
    parse; ``rejected`` adds the column ``_rejected`` with its text (null for good ones)."""
    return _json(spark, path, schema, False, rejected)


def read_json_array(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                    rejected: bool = False) -> DataFrame:
    """Files that hold one JSON array of records each (the dashboard files). A file is read by
    one task; of a damaged file ``rejected`` keeps the text from where it stops to parse."""
    return _json(spark, path, schema, True, rejected)


# --- one pass: good rows, rejects and their counts ------------------------------------------

@dataclass
class Loaded:
    """What one pass over an input has written: good rows, rejects, and how many of each."""

    rows: DataFrame
    rejects: DataFrame
    n_read: int
    n_rejected: int


def load_checked(df: DataFrame, path: str) -> Loaded:
    """Writes ``df`` (read with ``rejected=True``) once, good rows and rejects apart, and counts
    both in the pass that writes them (``observe``): the input is read and parsed one time."""
    seen = Observation("load")
    bad = F.col(REJECTED).isNotNull()
    # the metrics stand below the write, so a retried task is counted once
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_read"),
                         F.sum(bad.cast("long")).alias("n_rejected"))
    counted.withColumn("rejected_row", bad).write.partitionBy("rejected_row").parquet(path)
    back = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("rejected_row", T.BooleanType())]))
    whole = back.option("basePath", path).parquet(path)
    part = lambda flag: whole.where(F.col("rejected_row") == flag)
    got = seen.get
    return Loaded(part(False).drop(REJECTED, "rejected_row"), part(True).drop("rejected_row"),
                  got["n_read"], got["n_rejected"] or 0)


def load_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- writers ------------------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a table; CSV gets a header. No collect: every task writes its part."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_features(df: DataFrame, path: str, features: str = "features",
                   label: str = "delay_label") -> None:
    write_table(df.select(features, label), path)


def publish_features(df: DataFrame, base: str, features: str = "features",
                     label: str = "delay_label") -> str:
    """The feature table as a new version of ``base``: readers keep the old one until the write
    has ended (see ``sources.publish``)."""
    return publish_table(df.select(features, label), base)


def write_lookups(lookups: dict[str, DataFrame], base: str, fmt: str = "parquet") -> None:
    """Write each lookup table under ``base/<name>``."""
    for name, df in lookups.items():
        write_table(df, f"{base.rstrip('/')}/{name}", fmt=fmt)


def publish_lookups(lookups: dict[str, DataFrame], base: str) -> str:
    """All lookup tables as one new version of ``base``: a reader never mixes the tables of two
    runs, and sees none of a run that failed between them."""
    spark = next(iter(lookups.values())).sparkSession

    def write(path: str) -> None:
        for name, df in lookups.items():
            df.write.parquet(f"{path}/{name}")

    return publish(spark, base, write)


def read_lookup(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = current(spark, base)
    if path is None:
        raise FileNotFoundError(f"no lookups are published at {base}")
    return spark.read.parquet(f"{path}/{name}")

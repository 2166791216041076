"""Projection, filtering and row-local feature operators (no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K


def select_available(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def drop_leakage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop outcome and unused columns; absent names are ignored."""
    cols = list(K.LEAKAGE_COLUMNS) + list(K.UNUSED_COLUMNS) if cols is None else list(cols)
    return df.drop(*cols)


def rename_key(df: DataFrame, old: str = "IATA_CODE", new: str = "Dep_Airport") -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any column, or in ``subset``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column constant fill; columns not present are skipped.

    Written with ``coalesce`` (and NaN handling for doubles) instead of
    ``fillna`` so a fractional fill into an int column widens the column rather
    than truncating the value.
    """
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        if name not in values:
            out.append(F.col(name))
            continue
        v = values[name]
        col = F.col(name)
        if types[name] in ("double", "float"):
            col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
        if isinstance(v, float) and types[name] in ("int", "bigint", "smallint", "tinyint"):
            col = col.cast("double")
        out.append(F.coalesce(col, F.lit(v)).alias(name))
    return df.select(*out)


def align_columns(df: DataFrame, cols: Sequence[str], fill=0) -> DataFrame:
    """Exactly ``cols`` in that order; absent ones become the constant ``fill``."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in cols])


def prefix_columns(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    """Names of the columns that start with one of the prefixes (schema only)."""
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def calendar_features(df: DataFrame, date_col: str = "FlightDate") -> DataFrame:
    """year, month, day, day_of_week (Sunday = 1, as the classifier was trained)."""
    d = F.col(date_col)
    return df.select("*", F.year(d).alias("year"), F.month(d).alias("month"),
                     F.dayofmonth(d).alias("day"), F.dayofweek(d).alias("day_of_week"))


def add_weekend_flag(df: DataFrame, iso_dow_col: str = "Day_Of_Week") -> DataFrame:
    return df.withColumn("is_weekend", C.weekend_flag(iso_dow_col))


def parse_travel_date(df: DataFrame, text_col: str = "travel_date") -> DataFrame:
    """(month, day, iso dow, day name, weekend) from request text.

    Unparseable text falls back to (1, 1, 1, Monday, false).
    """
    d = C.to_date_lenient(F.col(text_col), "yyyy-MM-dd")
    return df.select(
        "*",
        F.coalesce(F.month(d), F.lit(1)).alias("req_month"),
        F.coalesce(F.dayofmonth(d), F.lit(1)).alias("req_day"),
        F.coalesce(C.iso_dow(d), F.lit(1)).alias("req_iso_dow"),
        F.coalesce(F.date_format(d, "EEEE"), F.lit("Monday")).alias("req_day_name"),
        F.coalesce(C.iso_dow(d) >= 6, F.lit(False)).alias("req_is_weekend"),
    )


def temp_range_filter(df: DataFrame, col: str = "temperature_c",
                      lo: float = K.TEMP_RANGE[0], hi: float = K.TEMP_RANGE[1]) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normalise request fields and split into (valid, rejected with a reason).

    Airports are trimmed and upper-cased, the airline key trimmed; a blank
    airline, departure or arrival rejects the row. The two outputs are filters
    of one projection, so no data moves.
    """
    norm = df.select(
        *[c for c in df.columns if c not in ("airline_key", "dep_airport", "arr_airport",
                                             "dep_time")],
        F.trim(F.col("airline_key")).alias("airline_key"),
        C.normalise_code("dep_airport").alias("dep_airport"),
        C.normalise_code("arr_airport").alias("arr_airport"),
        F.coalesce(F.col("dep_time"), F.lit("Morning")).alias("dep_time"),
    )
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    reason = (F.when(blank("airline_key"), F.lit("missing airline"))
               .when(blank("dep_airport"), F.lit("missing departure airport"))
               .when(blank("arr_airport"), F.lit("missing arrival airport")))
    tagged = norm.withColumn("reject_reason", reason)
    valid = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.where(F.col("reject_reason").isNotNull())
    return valid, rejected

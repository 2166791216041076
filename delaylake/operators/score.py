"""Set-at-a-time scoring of delay requests.

A request (airline, departure, arrival, travel date, slot) is enriched with
the same lookups the form uses -- month weather of the departure airport,
coordinates, route estimate, departure and arrival delay rates -- then scored
by the classifier; the probability becomes a risk bracket and a log row.
All lookups are small dimension tables joined to the requests; the models are
applied per row inside the executors (no collect, no per-request job), so the
same code serves a batch DataFrame and a stream.

Column names resolve case-insensitively in Spark, so the classifier's
``day_of_week`` (Sunday = 1) and the regressor's ISO day live under
different names (``dow_iso``), and the route estimate's duration is carried
only as ``Flight_Duration``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import joins as J
from delaylake.operators.models import positive_probability
from delaylake.operators.projection import parse_travel_date, validate_requests
from delaylake.session import materialize

REQUEST_COLS = ["request_id", "airline_key", "dep_airport", "arr_airport", "travel_date",
                "dep_time"]


def request_features(req: DataFrame, weather_avg: DataFrame, coords: DataFrame,
                     rates: DataFrame) -> DataFrame:
    """Request columns + everything the classifier and the regressor read.

    ``day_of_week`` uses the training numbering (Sunday = 1); the reference
    fed the serving numbering (Monday = 1) into the same slot, which this
    does not copy.
    """
    base = req.select(*REQUEST_COLS)
    p = parse_travel_date(base)
    w = J.lookup_weather_default(p, weather_avg)
    c = J.lookup_coords_default(w, coords)
    r = J.route_estimate(c, coords)
    d = J.lookup_delay_default(r, rates)
    date = C.to_date_lenient("travel_date", "yyyy-MM-dd")
    return d.select(
        *REQUEST_COLS,
        F.col("airline_key").alias("Airline"),
        F.col("dep_time").alias("DepTime_label"),
        F.col("route_type").alias("Distance_type"),
        F.col("req_month").alias("month"),
        F.coalesce(F.dayofweek(date), F.lit(2)).alias("day_of_week"),   # bad date: Monday
        F.col("req_day").alias("day"),
        F.col("req_iso_dow").alias("dow_iso"),
        F.col("req_is_weekend").cast("int").alias("is_weekend"),
        F.col("flight_duration").alias("Flight_Duration"),
        F.lit(K.DEFAULT_AIRCRAFT_AGE).alias("Aicraft_age"),
        *K.WEATHER_COLS, "LATITUDE", "LONGITUDE",
        "dep_airport_delay_avg", "arr_airport_delay_avg",
    )


def classify(feats: DataFrame, classifier) -> DataFrame:
    """Features + ``p_delay`` and ``risk``; the model's own columns dropped."""
    s = classifier.transform(feats)
    p = positive_probability(s)
    return s.select(*feats.columns, p.alias("p_delay"), C.risk_level(p).alias("risk"))


def conditional_minutes(classified: DataFrame, regressor) -> DataFrame:
    """Estimated delay minutes for medium / high risk only: max(0, round(pred))
    with half-even rounding; low risk gets null.

    The classified rows are written once, so that the regressor's trees run on the rows that
    ask for minutes alone and the classifier runs once for both branches. A stream cannot be
    written here (its sink does that): there the trees see every row in one pass.
    """
    wanted = F.col("risk").isin("high", "medium")
    mins = F.greatest(F.lit(0), F.bround("prediction", 0).cast("int"))
    if classified.isStreaming:
        est = regressor.transform(classified)
        return est.select(*classified.columns, F.when(wanted, mins).alias("est_delay_mins"))
    rows = materialize(classified, "classified")
    est = regressor.transform(rows.where(wanted)).select(*rows.columns, mins.alias("est_delay_mins"))
    rest = rows.where(~F.coalesce(wanted, F.lit(False)))
    return est.unionByName(rest.withColumn("est_delay_mins", F.lit(None).cast("int")))


def log_rows(classified: DataFrame, model_name: str, source: str) -> DataFrame:
    """Prediction-log shape (+ request_id, verdict, est_delay_mins if present)."""
    rb = C.risk_bracket("p_delay")
    pct, on_time = C.percent_fields("p_delay")
    extra = ["est_delay_mins"] if "est_delay_mins" in classified.columns else []
    return classified.select(
        "request_id",
        F.current_timestamp().alias("timestamp"),
        F.lit(source).alias("source"),
        C.airline_display("airline_key").alias("airline"),
        "dep_airport", "arr_airport",
        C.route_label("dep_airport", "arr_airport").alias("route"),
        "travel_date", "dep_time",
        pct.alias("delay_prob"), on_time.alias("on_time_prob"),
        rb["label"].alias("prediction"), rb["risk"].alias("risk"), rb["verdict"].alias("verdict"),
        F.lit(model_name).alias("model_used"),
        F.col("Flight_Duration").alias("flight_duration"),
        F.col("Distance_type").alias("route_type"),
        F.struct(*[F.bround(F.col(c), 2).alias(c) for c in K.WEATHER_COLS]).alias("weather"),
        *extra,
    )


def score_requests(req: DataFrame, weather_avg: DataFrame, coords: DataFrame, rates: DataFrame,
                   classifier, regressor=None, model_name: str = K.MODEL_NAMES["gbt"],
                   source: str = "batch", validate: bool = True, stage_lookups: bool = False,
                   deal: bool = True) -> DataFrame:
    """Scored requests as prediction-log rows; with a regressor, medium and
    high risk rows also get estimated delay minutes. Fields are normalised and
    blank requests left out, as the stream does; ``validate=False`` is for
    requests that :func:`validate_requests` has already split. ``stage_lookups``
    writes the lookups first: for lookups that are not tables yet. ``deal=False`` leaves the
    requests where they are: for requests that lie in many files of even size."""
    if validate:
        req, _ = validate_requests(req.select(*REQUEST_COLS))
    if deal and not req.isStreaming:
        # a row's trees cost far more than moving its six fields: deal the rows evenly, also
        # where they come from few files or one large row group
        req = req.hint("rebalance")
    if not req.isStreaming and stage_lookups:
        # aggregates are computed once, not for each use and each count of their rows
        weather_avg, coords, rates = (materialize(d, f"{n}-lookup") for n, d in (
            ("weather", weather_avg), ("coords", coords), ("rates", rates)))
    c = classify(request_features(req, weather_avg, coords, rates), classifier)
    if regressor is not None:
        c = conditional_minutes(c, regressor)
    return log_rows(c, model_name, source)

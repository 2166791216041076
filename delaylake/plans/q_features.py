
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import evaluate as E
from delaylake.operators import features as FE
from delaylake.operators import projection as P
from delaylake.operators.models import CLASSIFIER_NUMERIC
from delaylake.plans import fixtures as X
from delaylake.plans.oracle import with_views as W
from delaylake.plans.registry import query
from delaylake.sources.tables import load_driver_table
from delaylake.sources.views import FLIGHT_KEY

KEY = list(FLIGHT_KEY)
KS = ", ".join(KEY)
CK = ", ".join(f"c.{k}" for k in KEY)
CATS = list(K.CATEGORICAL_COLS)


def r6(c):
    return F.round(c, 6)


def _rank_cte(col: str, order: str) -> tuple[str, str]:
    o = "n DESC, v" if order == "freq" else "v"
    return (f"idx_{col}", f"SELECT v, row_number() OVER (ORDER BY {o}) - 1 AS i FROM "
                          f"(SELECT {col} AS v, count(*) AS n FROM clean WHERE {col} IS NOT NULL "
                          f"GROUP BY 1)")


_IDX_CTES = tuple(_rank_cte(c, "freq") for c in CATS)
_IDX_JOINS = " ".join(f"LEFT JOIN idx_{c} ON c.{c} = idx_{c}.v" for c in CATS)


def _indexed(spark, sf):
    c = X.clean(spark, sf)
    return FE.string_index(c, CATS).transform(c)


@query("string_index", W(f"""
SELECT {CK}, """ + ", ".join(
    f"CAST(coalesce(idx_{c}.i, (SELECT count(*) FROM idx_{c})) AS DOUBLE) AS {c}_idx" for c in CATS)
    + f" FROM clean c {_IDX_JOINS}", ctes=_IDX_CTES))
def q_string_index(spark, sf):
    return _indexed(spark, sf).select(*KEY, *[f"{c}_idx" for c in CATS])


_ENC = ["Dep_Airport", "Arr_Airport"]
_ENC_CTES = tuple(_rank_cte(c, "alpha") for c in _ENC)
_ENC_JOINS = " ".join(f"LEFT JOIN idx_{c} ON c.{c} = idx_{c}.v" for c in _ENC)


@query("label_encode", W(f"""
SELECT {CK}, """ + ", ".join(f"CAST(idx_{c}.i AS DOUBLE) AS {c}_Encoded" for c in _ENC)
                         + f" FROM clean c {_ENC_JOINS}", ctes=_ENC_CTES))
def q_label_encode(spark, sf):
    c = X.clean(spark, sf)
    return FE.label_encode(c, _ENC).transform(c).select(*KEY, *[f"{x}_Encoded" for x in _ENC])


@query("route_code", W(f"""
SELECT {CK}, CAST(idx_Dep_Airport.i * 1000 + idx_Arr_Airport.i AS INTEGER) AS route_code
FROM clean c {_ENC_JOINS}""", ctes=_ENC_CTES))
def q_route_code(spark, sf):
    c = X.clean(spark, sf)
    e = FE.label_encode(c, _ENC).transform(c)
    return e.select(*KEY, C.route_code(F.col("Dep_Airport_Encoded").cast("int"),
                                       F.col("Arr_Airport_Encoded").cast("int"))
                    .cast("int").alias("route_code"))


@query("one_hot", W(f"""
SELECT {CK}, """ + ", ".join(
    f"CAST(CASE WHEN idx_{c}.i < (SELECT count(*) FROM idx_{c}) THEN idx_{c}.i END AS INTEGER) "
    f"AS {c}_hot, CAST((SELECT count(*) FROM idx_{c}) AS INTEGER) AS {c}_size" for c in CATS)
    + f" FROM clean c {_IDX_JOINS}", ctes=_IDX_CTES))
def q_one_hot(spark, sf):
    ix = _indexed(spark, sf)
    oh = FE.one_hot(ix, [f"{c}_idx" for c in CATS]).transform(ix)
    cols = []
    for c in CATS:
        arr = vector_to_array(F.col(f"{c}_vec"))
        pos = F.array_position(arr, F.lit(1.0)).cast("int")
        cols += [F.when(pos > 0, pos - 1).alias(f"{c}_hot"), F.size(arr).alias(f"{c}_size")]
    return oh.select(*KEY, *cols)


_DUMMY_CATS = {
    "DepTime_label": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "Distance_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
}


@query("dummy_columns", W(f"SELECT {KS}, " + ", ".join(
    f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS \"{c}_{v}\""
    for c, vs in _DUMMY_CATS.items() for v in vs) + " FROM clean"))
def q_dummy_columns(spark, sf):
    c = X.clean(spark, sf).select(*KEY, *_DUMMY_CATS)
    return FE.dummy_columns(c, list(_DUMMY_CATS))


_ALIGN = ["month", "day_of_week", "Flight_Duration", "Aicraft_age", "tavg", "prcp",
          "LATITUDE", "LONGITUDE", "is_weekend", "Airline_Unknown"]


@query("align_columns", W(f"""
SELECT {KS}, month, day_of_week, Flight_Duration, Aicraft_age, round(tavg, 6) AS tavg,
       round(prcp, 6) AS prcp, LATITUDE, LONGITUDE,
       CASE WHEN isodow(FlightDate) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, 0 AS Airline_Unknown
FROM clean"""))
def q_align_columns(spark, sf):
    c = X.clean(spark, sf).withColumn("is_weekend", C.weekend_flag(C.iso_dow("FlightDate")))
    a = P.align_columns(c, KEY + _ALIGN)
    return a.withColumn("tavg", r6("tavg")).withColumn("prcp", r6("prcp"))


@query("assemble_features", W(f"""
SELECT {KS}, delay_label,
       CAST({len(CLASSIFIER_NUMERIC)} + """ + " + ".join(
    f"(SELECT count(DISTINCT {c}) FROM clean)" for c in CATS) + f""" AS INTEGER) AS n_features
FROM clean WHERE """ + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in CLASSIFIER_NUMERIC)))
def q_assemble_features(spark, sf):
    ix = _indexed(spark, sf)
    oh = FE.one_hot(ix, [f"{c}_idx" for c in CATS]).transform(ix)
    a = FE.assemble_features(oh, CLASSIFIER_NUMERIC + [f"{c}_vec" for c in CATS])
    return a.select(*KEY, "delay_label",
                    F.size(vector_to_array("features")).alias("n_features"))


_SCALE = ["tavg", "prcp", "wspd", "pres", "Flight_Duration"]


@query("standard_scale", W(f"SELECT {KS}, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in _SCALE)
    + " FROM clean"))
def q_standard_scale(spark, sf):
    c = X.clean(spark, sf).select(*KEY, *[F.col(x).cast("double").alias(x) for x in _SCALE])
    s = FE.standard_scale(c, _SCALE).transform(c)
    # + 0.0 turns a -0.0 into 0.0 on both sides
    return s.select(*KEY, *[(r6(x) + F.lit(0.0)).alias(x) for x in _SCALE])


@query("class_weights", W("""
SELECT delay_label, count(*) AS n_label,
       round((SELECT count(*) FROM clean) / (2.0 * count(*)), 6) AS weight
FROM clean GROUP BY 1"""))
def q_class_weights(spark, sf):
    w = FE.class_weights(X.clean(spark, sf))
    return w.withColumn("weight", r6("weight"))


_AUC_SQL = """
SELECT CAST(2 * sum(pos * coalesce(neg_below, 0)) + sum(pos * neg) AS DOUBLE)
       / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS auc
FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             AS neg_below
      FROM (SELECT dep_airport_delay_avg AS s, sum(delay_label) AS pos,
                   sum(1 - delay_label) AS neg
            FROM clean WHERE dep_airport_delay_avg IS NOT NULL GROUP BY 1))
"""


@query("eval_binary", W("""
SELECT round(a.auc, 6) AS auc, round(b.accuracy, 6) AS accuracy FROM auc_t a CROSS JOIN (
  SELECT avg(CASE WHEN CAST(dep_airport_delay_avg >= 0.5 AS INTEGER) = delay_label THEN 1.0
                  ELSE 0.0 END) AS accuracy FROM clean) b""", ctes=(("auc_t", _AUC_SQL),)))
def q_eval_binary(spark, sf):
    s = X.clean(spark, sf).select("delay_label", F.col("dep_airport_delay_avg").alias("score"))
    e = E.eval_binary(s, "delay_label", "score")
    return e.select(r6("auc").alias("auc"), r6("accuracy").alias("accuracy"))


@query("eval_binary_scores", """
WITH h AS (SELECT l_extendedprice / l_quantity AS s, count(*) FILTER (l_quantity > 25) AS p,
                  count(*) FILTER (NOT l_quantity > 25) AS n FROM lineitem GROUP BY 1),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT round((sum(CAST(p AS DOUBLE) * below) + sum(CAST(p AS DOUBLE) * n) / 2) / (CAST(sum(p) AS DOUBLE) * sum(n)), 9) AS auc,
       round(CAST(sum(CASE WHEN s >= 1500 THEN p ELSE n END) AS DOUBLE) / sum(p + n), 9) AS accuracy FROM b""")
def q_eval_binary_scores(spark, sf):
    """AUC of a score with about as many distinct values as rows."""
    li = load_driver_table(spark, sf, "lineitem")
    s = li.select((F.col("l_quantity") > 25).cast("int").alias("y"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("score"))
    return E.eval_binary(s, "y", "score", 1500).select(F.round("auc", 9).alias("auc"), F.round("accuracy", 9).alias("accuracy"))


_PRED = "CAST((dep_airport_delay_avg + arr_airport_delay_avg) / 2 > 0.2 AS INTEGER)"


@query("eval_report", W(f"""
SELECT cls AS class,
       round(coalesce(tp / nullif(CAST(predicted AS DOUBLE), 0), 0.0), 6) AS precision,
       round(coalesce(tp / nullif(CAST(support AS DOUBLE), 0), 0.0), 6) AS recall,
       round(coalesce(2 * (tp / nullif(CAST(predicted AS DOUBLE), 0)) * (tp / nullif(CAST(support AS DOUBLE), 0))
             / nullif((tp / nullif(CAST(predicted AS DOUBLE), 0)) + (tp / nullif(CAST(support AS DOUBLE), 0)), 0),
             0.0), 6) AS f1,
       CAST(support AS BIGINT) AS support
FROM (SELECT cls, sum(CASE WHEN y = cls AND p = cls THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y = cls THEN 1 ELSE 0 END) AS support,
             sum(CASE WHEN p = cls THEN 1 ELSE 0 END) AS predicted
      FROM (SELECT delay_label AS y, {_PRED} AS p FROM clean) t
      CROSS JOIN (SELECT DISTINCT delay_label AS cls FROM clean
                  UNION SELECT DISTINCT {_PRED} FROM clean) k
      GROUP BY cls)"""))
def q_eval_report(spark, sf):
    c = X.clean(spark, sf)
    pred = ((F.col("dep_airport_delay_avg") + F.col("arr_airport_delay_avg")) / 2 > 0.2).cast("int")
    r = E.eval_report(c.select("delay_label", pred.alias("prediction")))
    return r.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


@query("eval_regression", W("""
SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2
FROM (SELECT CAST(least(greatest(Arr_Delay, -30), 300) AS DOUBLE) AS y,
             CAST(least(greatest(Dep_Delay, 0), 300) AS DOUBLE) AS p
      FROM flights WHERE Arr_Delay IS NOT NULL)"""))
def q_eval_regression(spark, sf):
    f = X.flights(spark, sf).where(F.col("Arr_Delay").isNotNull())
    f = f.select(C.clip("Arr_Delay", -30, 300).alias("y"), F.col("Dep_Delay").alias("yhat"))
    e = E.eval_regression(f, "y", "yhat", clip=(0, 300))
    return e.select(*[r6(c).alias(c) for c in ("mae", "rmse", "r2")])

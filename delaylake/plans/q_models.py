"""

A fitted model has no SQL form, but its rows, keys, labels and everything that
does not come from the model have, and so have the checks that each query
makes of the model's own columns: probabilities lie in [0, 1] and add to one,
the training loss is below the base rate's, risk and label follow from the
probability, minutes are null exactly for low risk, importances add to one.

The models are fitted on a label that depends on their inputs: the flight's
delay plus a number of minutes for the departure slot and the month.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators import aggregates as A
from delaylake.operators import evaluate as E
from delaylake.operators import features as FE
from delaylake.operators import models as M
from delaylake.operators import sampling as S
from delaylake.operators import score as SC
from delaylake.operators.models import CLASSIFIER_NUMERIC, positive_probability
from delaylake.plans import fixtures as X
from delaylake.plans.oracle import round_even
from delaylake.plans.oracle import with_views as W
from delaylake.plans.q_core import (_BAL_D, _BAL_N, _BAL_O, _REQ_PARSED_SQL, _ROUTE_COLS, _ROUTE_SQL,
                                    _WAVG_SQL, _bucket_sql)
from delaylake.plans.registry import query
from delaylake.plans.training import regression_frame
from delaylake.session import materialize, path_exists, scan_splits, scratch_path, split_size
from delaylake.sources import views as V
from delaylake.sources.views import FLIGHT_KEY
from delaylake.streaming.score_stream import drain, stream_log_brackets, stream_score_log

KEY = list(FLIGHT_KEY)
KS = ", ".join(KEY)
CATS = list(K.CATEGORICAL_COLS)

_KEPT: dict[tuple, object] = {}     # tables and models shared by queries of one input folder


def _once(spark, sf, name, make):
    key = (spark.sparkContext.applicationId, sf, name)
    kept = _KEPT.get(key)
    tables = [d for d in (kept if isinstance(kept, tuple) else (kept,)) if isinstance(d, DataFrame)]
    if not all(path_exists(spark, f) for d in tables for f in d.inputFiles()[:1]):
        kept = None     # released since
    if kept is None:
        kept = _KEPT[key] = make()
    return kept


def r6(c):
    return F.round(c, 6)


# Minutes that slot and month add to a flight's delay before it is labelled.
_SLOT_MINUTES = {"1-URGENT": 150, "2-HIGH": 60}
_MONTH_MINUTES = 15
_LABEL_SQL = ("CASE WHEN Arr_Delay + CASE DepTime_label "
              + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SLOT_MINUTES.items())
              + f" ELSE 0 END + {_MONTH_MINUTES} * month > 15 THEN 1 ELSE 0 END")


def model_rows(spark, sf):
    """Rows of the clean table with the label the models learn, columns pruned."""
    added = F.lit(0)
    for slot, minutes in _SLOT_MINUTES.items():
        added = F.when(F.col("DepTime_label") == slot, minutes).otherwise(added)
    late = F.col("Arr_Delay") + added + _MONTH_MINUTES * F.col("month")
    return X.clean(spark, sf).select(*KEY, *CATS, *CLASSIFIER_NUMERIC,
                                     C.delay_label(late).alias("delay_label"))


def _in_fit_files(rows, name):
    """``rows`` written in files that a learner's task can hold, so that they need no dealing."""
    with scan_splits(rows.sparkSession, split_size(rows, M.FIT_ROWS)):
        return materialize(rows, name)


def _split(spark, sf):
    rows = _once(spark, sf, "model-rows", lambda: _in_fit_files(model_rows(spark, sf), "model-rows"))
    return S.split_train_test(rows, KEY)


def gbt_model(spark, sf, max_iter=10, max_depth=4):
    train, _ = _split(spark, sf)
    return _once(spark, sf, f"gbt-{max_iter}-{max_depth}",
                 lambda: M.gbt_classifier(train, max_iter=max_iter, max_depth=max_depth))


def log_loss(scored, p="p", label="delay_label"):
    """One row: mean log loss of ``p`` and of the base rate."""
    q = F.greatest(F.least(F.col(p), F.lit(1 - 1e-9)), F.lit(1e-9))
    base = F.avg(label)
    return scored.agg(
        F.avg(-(F.col(label) * F.log(q) + (1 - F.col(label)) * F.log(1 - q))).alias("loss"),
        (-(base * F.log(base) + (1 - base) * F.log(1 - base))).alias("base_loss"))


def _checked(model, train, test):
    """Held-out keys and labels, whether each row's probability is valid and
    agrees with its prediction, and whether the model beats the base rate."""
    learnt = log_loss(model.transform(train).select(
        "delay_label", vector_to_array("probability")[1].alias("p")))
    s = model.transform(test)
    pr = vector_to_array("probability")
    ok = (pr[0].between(0, 1) & pr[1].between(0, 1) & (F.abs(pr[0] + pr[1] - 1) < 1e-9)
          & ((pr[1] == 0.5) | ((pr[1] > 0.5) == (F.col("prediction") == 1.0))))
    return (s.select(*KEY, "delay_label", ok.alias("valid_probability"))
             .crossJoin(F.broadcast(learnt.select((F.col("loss") < F.col("base_loss")).alias("beats_base_rate")))))


_CHECKED_SQL = W(f"""
SELECT {KS}, {_LABEL_SQL} AS delay_label, true AS valid_probability, true AS beats_base_rate
FROM clean WHERE {_bucket_sql(KEY)} >= 8000""")


@query("gbt_classifier", _CHECKED_SQL)
def q_gbt_classifier(spark, sf):
    return _checked(gbt_model(spark, sf), *_split(spark, sf))


@query("gbt_classifier_20x5", _CHECKED_SQL)
def q_gbt_classifier_20x5(spark, sf):
    return _checked(gbt_model(spark, sf, 20, 5), *_split(spark, sf))


@query("rf_classifier", _CHECKED_SQL)
def q_rf_classifier(spark, sf):
    train, test = _split(spark, sf)
    return _checked(M.rf_classifier(train, num_trees=50, max_depth=10), train, test)


@query("rf_classifier_balanced", W(f"""
SELECT {KS}, {_LABEL_SQL} AS delay_label, true AS threshold_kept
FROM clean WHERE {_bucket_sql(KEY)} >= 8000"""))
def q_rf_classifier_balanced(spark, sf):
    """The tuned forest: 200 trees of depth 15, two rows a leaf, balanced
    weights, and the 0.6 confidence threshold."""
    train, test = _split(spark, sf)
    model = M.rf_classifier(FE.with_class_weights(train), num_trees=200, max_depth=15, min_instances=2,
                            weight_col="weight")
    s = model.transform(test).withColumn("p", vector_to_array("probability")[1])
    label = C.confidence_threshold("p")
    return s.select(*KEY, "delay_label",
                    (F.col("p").between(0, 1) & ((label == 1) == (F.col("p") > 0.6))).alias("threshold_kept"))


def svm_model(spark, sf):
    train, _ = _split(spark, sf)
    return _once(spark, sf, "svm", lambda: M.svm_calibrated(train, KEY, folds=3))


@query("svm_calibrated", _CHECKED_SQL)
def q_svm_calibrated(spark, sf):
    return _checked(svm_model(spark, sf), *_split(spark, sf))


@query("model_auc", W("SELECT true AS better_than_chance"))
def q_model_auc(spark, sf):
    """Exact AUC of the classifier on held-out flights, against chance."""
    _, test = _split(spark, sf)
    s = gbt_model(spark, sf).transform(test)
    auc = E.auc(s.select("delay_label", positive_probability(s).alias("score")), "delay_label", "score")
    return auc.select((F.col("auc") > 0.6).alias("better_than_chance"))


def _regression_rows(spark, sf):
    return _once(spark, sf, "regression-rows", lambda: _in_fit_files(
        regression_frame(X.shared_flights(spark, sf), X.weather(spark, sf), X.airports(spark, sf), KEY),
        "regression-rows"))


def regressor(spark, sf):
    train, _ = S.split_train_test(_regression_rows(spark, sf), KEY)
    return _once(spark, sf, "regressor", lambda: M.gbt_regressor(
        train, max_iter=100, max_depth=4, subsample=0.8))


_BALANCED = ("balanced", f"""
SELECT {KS}, Arr_Delay FROM bal_d WHERE Arr_Delay > 15
UNION ALL
SELECT {KS}, greatest(Arr_Delay, 0) AS Arr_Delay FROM bal_o WHERE rk <= (SELECT n FROM bal_n)""")


@query("gbt_regressor", W(f"""
SELECT {KS}, Arr_Delay, true AS finite_minutes, true AS beats_mean
FROM balanced WHERE {_bucket_sql(KEY)} >= 8000""",
                          ctes=(("bal_d", _BAL_D), ("bal_n", _BAL_N), ("bal_o", _BAL_O), _BALANCED)))
def q_gbt_regressor(spark, sf):
    train, test = S.split_train_test(_regression_rows(spark, sf), KEY)
    model = regressor(spark, sf)
    better = E.eval_regression(model.transform(train), "Arr_Delay", "prediction", None).select(
        (F.col("r2") > 0).alias("beats_mean"))
    s = model.transform(test)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < 1e6)
    return s.select(*KEY, "Arr_Delay", finite.alias("finite_minutes")).crossJoin(F.broadcast(better))


@query("feature_importance", W(
    f"SELECT CAST({len(CLASSIFIER_NUMERIC)} + "
    + " + ".join(f"(SELECT count(DISTINCT {c}) FROM clean WHERE {_bucket_sql(KEY)} < 8000)" for c in CATS)
    + " AS BIGINT) AS n_features, true AS shares_add_to_one, true AS learnt_slot_or_month"))
def q_feature_importance(spark, sf):
    _, test = _split(spark, sf)
    model = gbt_model(spark, sf)
    imp = M.feature_importance(model, model.transform(test.limit(1)))
    used = F.col("feature").startswith("DepTime_label") | (F.col("feature") == "month")
    return imp.agg(F.count(F.lit(1)).alias("n_features"),
                   (F.abs(F.sum("share") - 1) < 1e-6).alias("shares_add_to_one"),
                   (F.sum(F.when(used, F.col("share")).otherwise(0.0)) > 0.2).alias("learnt_slot_or_month"))


def _lookups(spark, sf):
    """The lookups of the requests, written once; the rates come from the clean table that the
    model's rows come from."""
    return _once(spark, sf, "lookups", lambda: tuple(materialize(d, f"{n}-lookup") for n, d in (
        ("weather", A.weather_monthly_avg(X.weather(spark, sf))), ("coords", X.airports(spark, sf)),
        ("rates", A.delay_rate(X.clean(spark, sf))))))


def _requests(spark, sf):
    """The requests, from flights written once: before the clean table, which reads them too."""
    return V.requests(spark, sf, X.shared_flights(spark, sf))


def _score_checks():
    """Risk and label follow from the probability; the percentages add up."""
    p, o = F.col("delay_prob"), F.col("on_time_prob")
    risk = F.when(p > 40, "high").when(p < 25, "low").when((p > 25) & (p < 40), "medium")
    label = F.element_at(F.create_map(*[F.lit(x) for kv in (("high", "DELAYED"), ("medium", "POSSIBLY DELAYED"),
                                                            ("low", "ON TIME")) for x in kv]), F.col("risk"))
    return (F.coalesce(F.col("risk") == risk, F.col("risk").isin("high", "medium", "low")).alias("risk_follows"),
            (F.col("prediction") == label).alias("label_follows"),
            (F.abs(p + o - 100) < 0.11).alias("percents_add_up"))


_SCORED_COLS = ["request_id", "airline", "route", "travel_date", "dep_time", "model_used",
                "flight_duration", "route_type"]
_SCORED_SQL = f"""
SELECT q.request_id, q.airline_key AS airline, concat_ws(' → ', q.dep_airport, q.arr_airport) AS route,
       q.travel_date, q.dep_time, '{K.MODEL_NAMES["gbt"]}' AS model_used, q.flight_duration, q.route_type,
       {round_even("coalesce(w.tavg, 15.0)", 2)} AS tavg, {round_even("coalesce(w.prcp, 2.0)", 2)} AS prcp,
       {round_even("coalesce(w.wspd, 15.0)", 2)} AS wspd, {round_even("coalesce(w.pres, 1013.0)", 2)} AS pres,
       true AS risk_follows, true AS label_follows, true AS percents_add_up
FROM (SELECT rt.request_id, rt.airline_key, rt.dep_airport, rt.arr_airport, rt.travel_date, rt.dep_time,
             {_ROUTE_COLS}, p.req_month
      FROM routes rt JOIN rq p ON rt.request_id = p.request_id) q
LEFT JOIN wavg w ON q.dep_airport = w.airport_id AND q.req_month = w.month
"""
_SCORED_CTES = (("wavg", _WAVG_SQL), ("routes", _ROUTE_SQL),
                ("rq", f"SELECT DISTINCT request_id, req_month FROM ({_REQ_PARSED_SQL})"))


def _flat(scored):
    return scored.select(*_SCORED_COLS, *[F.col(f"weather.{c}").alias(c) for c in K.WEATHER_COLS],
                         *_score_checks())


@query("score_requests", W(_SCORED_SQL, ctes=_SCORED_CTES))
def q_score_requests(spark, sf):
    requests = _requests(spark, sf)
    s = SC.score_requests(requests, *_lookups(spark, sf), gbt_model(spark, sf), deal=False)
    return _flat(s)


@query("conditional_minutes", W("SELECT request_id, true AS minutes_follow_risk FROM requests"))
def q_conditional_minutes(spark, sf):
    requests = _requests(spark, sf)
    s = SC.score_requests(requests, *_lookups(spark, sf), gbt_model(spark, sf),
                          regressor=regressor(spark, sf), deal=False)
    follow = F.when(F.col("risk") == "low", F.col("est_delay_mins").isNull()).otherwise(
        F.coalesce(F.col("est_delay_mins") >= 0, F.lit(False)))
    return s.select("request_id", follow.alias("minutes_follow_risk"))


@query("stream_score_log", W(f"SELECT *, true AS same_as_batch FROM ({_SCORED_SQL})", ctes=_SCORED_CTES))
def q_stream_score_log(spark, sf):
    """Request files scored by the model as a stream into the log; the drained
    log is compared with the batch result row by row, all but the time stamp."""
    inbox, out = scratch_path(spark, "stream-requests"), scratch_path(spark, "stream-log")
    _requests(spark, sf).write.parquet(inbox)
    weather_avg, coords, rates = _lookups(spark, sf)
    model = gbt_model(spark, sf)
    drain(stream_score_log(spark, inbox, out, out + "-ckpt", weather_avg, coords, rates, model, fmt="parquet"))
    logged = spark.read.parquet(out)
    batch = SC.score_requests(spark.read.parquet(inbox), weather_avg, coords, rates, model, deal=False)
    same = [c for c in batch.columns if c in logged.columns and c not in ("request_id", "timestamp", "source")]
    digest = F.xxhash64(*[F.to_json(F.struct(*same))])
    b = batch.select("request_id", digest.alias("__digest")).distinct().withColumn("__same", F.lit(True))
    both = logged.withColumn("__digest", digest).join(b, ["request_id", "__digest"], "left")
    return _flat_with(both, F.coalesce("__same", F.lit(False)))


def _flat_with(scored, same):
    return scored.select(*_SCORED_COLS, *[F.col(f"weather.{c}").alias(c) for c in K.WEATHER_COLS],
                         *_score_checks(), same.alias("same_as_batch"))


_STREAM_COLS = 'event_id, "timestamp", source, delay_prob, on_time_prob, prediction, risk'


@query("stream_log_brackets", W(f"SELECT {_STREAM_COLS} FROM log_t"))
def q_stream_log_brackets(spark, sf):
    out = scratch_path(spark, "stream-brackets")
    drain(stream_log_brackets(spark, sf, out, out + "-ckpt"))
    return spark.read.parquet(out)

"""Registered queries of sources, sinks and persistence: each writes a table derived from the
driver's tables in the form the operator makes, reads it back, and is compared with SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylake.functions import constants as K
from delaylake.operators import aggregates as A
from delaylake.operators import joins as J
from delaylake.operators import models as M
from delaylake.operators import projection as P
from delaylake.operators import sampling as S
from delaylake.operators.stages import TrainingFill
from delaylake.plans import fixtures as X
from delaylake.plans import q_models as QM
from delaylake.plans.oracle import with_views as W
from delaylake.plans.registry import query
from delaylake.session import materialize, scratch_path
from delaylake.sources import log as LOG
from delaylake.sources import tables as TB
from delaylake.sources.publish import read_published
from delaylake.sources.stored import open_stored, write_clean_table
from delaylake.streaming.score_stream import drain, event_brackets, read_event_stream, start_log_sink

_STREAM_COLS = 'event_id, "timestamp", source, delay_prob, on_time_prob, prediction, risk'
_STREAM_NAMES = ["event_id", "timestamp", "source", "delay_prob", "on_time_prob", "prediction", "risk"]


def _logged(spark, sf):
    """The events streamed into a log of numbered batches; events without a value are rejects.
    Returns its path."""
    def score(batch):
        bad = F.col("value").isNull() | (F.col("event_id") % 17 == 0)
        return event_brackets(batch.where(~bad)), batch.where(bad).select("event_id", "event_type")

    path = scratch_path(spark, "batch-log")
    drain(start_log_sink(read_event_stream(spark, sf), score, path, f"{path}-ckpt"))
    return path


@query("append_prediction_log", W(f"""
SELECT {_STREAM_COLS}, CAST("timestamp" AS DATE) AS log_date, 'logged' AS went FROM log_t WHERE event_id % 17 <> 0
UNION ALL
SELECT event_id, NULL, source, NULL, NULL, NULL, NULL, NULL, 'rejected' FROM log_t WHERE event_id % 17 = 0"""))
def q_append_prediction_log(spark, sf):
    path = _logged(spark, sf)
    rows = LOG.read_log(spark, path).select(*_STREAM_NAMES, "log_date", F.lit("logged").alias("went"))
    lost = LOG.read_rejected(spark, path).select("event_id", F.col("event_type").alias("source"),
                                                 F.lit("rejected").alias("went"))
    return rows.unionByName(lost, allowMissingColumns=True)


@query("latest_rows", W(f"""
SELECT {_STREAM_COLS} FROM log_t WHERE event_id % 17 <> 0 ORDER BY "timestamp" DESC, event_id LIMIT 25"""))
def q_latest_rows(spark, sf):
    path = _logged(spark, sf)
    return LOG.latest_rows(spark, f"{path}/log", 25, tie="event_id", log=LOG.read_log(spark, path)).select(
        *_STREAM_NAMES)


_CSV_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_shipdate", T.DateType()),
    T.StructField("l_returnflag", T.StringType())])
_DAMAGED = "l_orderkey % 7 = 3 AND l_linenumber = 2"


def _csv(spark, sf):
    """lineitem as CSV files with a byte order mark and blanks in the header, the columns in
    another order, one that nobody asked for, padded cells, and numbers that are none."""
    text = lambda c: F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" "))
    quantity = F.when(F.expr(_DAMAGED), F.lit("about 5")).otherwise(F.col("l_quantity").cast("string"))
    rows = TB.load_driver_table(spark, sf, "lineitem").select(
        text("l_returnflag").alias("\ufeff l_returnflag "), quantity.alias("L_QUANTITY"),
        F.lit("z").alias(" unused"), F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate "),
        text("l_linenumber").alias("l_linenumber"), F.col("l_orderkey").alias(" l_orderkey"))
    path = scratch_path(spark, "csv")
    (rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@query("read_csv_table", f"""
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
       CASE WHEN {_DAMAGED} THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS l_quantity, {_DAMAGED} AS rejected,
       (SELECT count(*) FROM lineitem) AS n_read, (SELECT count(*) FROM lineitem WHERE {_DAMAGED}) AS n_rejected
FROM lineitem""")
def q_read_csv_table(spark, sf):
    """One pass writes the rows, the rejects and their counts."""
    read = TB.read_csv_table(spark, _csv(spark, sf), _CSV_SCHEMA, rejected=True)
    got = TB.load_checked(read, scratch_path(spark, "csv-loaded"))
    names = ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity"]
    part = lambda df, flag: df.select(*names, F.lit(flag).alias("rejected"))
    return part(got.rows, False).union(part(got.rejects, True)).withColumns(
        {"n_read": F.lit(got.n_read).cast("long"), "n_rejected": F.lit(got.n_rejected).cast("long")})


@query("read_csv_pruned", """
SELECT CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL""")
def q_read_csv_pruned(spark, sf):
    """Two of the columns, by name: damage in the others is never looked at."""
    df = TB.read_csv_table(spark, _csv(spark, sf), _CSV_SCHEMA, columns=["l_shipdate", "l_returnflag"])
    return df.groupBy("l_shipdate", "l_returnflag").agg(F.count("*").alias("n"))


@query("read_json_records", """
SELECT event_id, CASE WHEN event_id % 11 = 5 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 11 = 5 THEN NULL ELSE CAST(value AS DOUBLE) END AS value,
       event_id % 11 = 5 AS rejected, 'lines' AS form FROM events
UNION ALL SELECT event_id, event_type, CAST(value AS DOUBLE), false, 'array' FROM events""")
def q_read_json_records(spark, sf):
    """The events as JSON lines, some cut off, and as files of one array of up to 1000 each."""
    ev = TB.load_driver_table(spark, sf, "events").select("event_id", "event_type", F.col("value").cast("double").alias("value"))
    record = F.to_json(F.struct("event_id", "event_type", "value"), {"ignoreNullFields": "false"})
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"br'))
    lines, arrays = scratch_path(spark, "json-lines"), scratch_path(spark, "json-arrays")
    ev.select(F.when(F.col("event_id") % 11 == 5, cut).otherwise(record).alias("value")).write.text(lines)
    (ev.groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(F.collect_list(record).alias("records"))
     .select("part", F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("value"))
     .write.partitionBy("part").text(arrays))
    schema = "event_id bigint, event_type string, value double"
    bad = F.col(TB.REJECTED).isNotNull()
    a = TB.read_json_records(spark, lines, schema, rejected=True)
    whole_id = F.when(bad, F.regexp_extract(TB.REJECTED, r'"event_id":(\d+)', 1).cast("bigint")).otherwise(F.col("event_id"))
    a = a.select(whole_id.alias("event_id"), F.when(~bad, F.col("event_type")).alias("event_type"), "value",
                 bad.alias("rejected"), F.lit("lines").alias("form"))
    b = TB.read_json_array(spark, arrays, schema, rejected=True)
    return a.union(b.select("event_id", "event_type", "value", bad, F.lit("array")))


@query("rename_key", W("SELECT IATA_CODE AS Dep_Airport, LATITUDE, LONGITUDE FROM airports"))
def q_rename_key(spark, sf):
    return P.rename_key(X.airports(spark, sf), "IATA_CODE", "Dep_Airport")


@query("prefix_columns", W("""
SELECT airport_id, "time", CAST(tavg AS DOUBLE) AS tavg, CAST(prcp AS DOUBLE) AS prcp, CAST(pres AS DOUBLE) AS pres
FROM weather"""))
def q_prefix_columns(spark, sf):
    w = X.weather(spark, sf)
    names = P.prefix_columns(w, ["t", "p"])
    return w.select("airport_id", *[F.col(c).cast("double").alias(c) if c in K.WEATHER_COLS else F.col(c) for c in names])


@query("write_lookups", W("""
SELECT 'weather' AS lookup, airport_id AS airport, CAST(month AS INTEGER) AS month, round(tavg, 6) AS value
FROM (SELECT airport_id, month("time") AS month, avg(CAST(tavg AS DOUBLE)) AS tavg FROM weather GROUP BY ALL)
UNION ALL SELECT 'coords', IATA_CODE, NULL, LATITUDE FROM airports"""))
def q_write_lookups(spark, sf):
    """Two runs publish the lookups under one base; the second is read back."""
    weather = (X.weather(spark, sf).groupBy("airport_id", F.month("time").alias("month"))
               .agg(F.avg(F.col("tavg").cast("double")).alias("tavg")))
    coords = X.airports(spark, sf)
    base = scratch_path(spark, "lookups")
    TB.publish_lookups({"weather": weather.limit(0), "coords": coords.limit(0)}, base)
    TB.publish_lookups({"weather": weather, "coords": coords}, base)
    w, c = (TB.read_lookup(spark, base, n) for n in ("weather", "coords"))
    return w.select(F.lit("weather").alias("lookup"), F.col("airport_id").alias("airport"), "month",
                    F.round("tavg", 6).alias("value")).union(
        c.select(F.lit("coords"), "IATA_CODE", F.lit(None).cast("int"), "LATITUDE"))


_FEATURES = ["tavg", "prcp", "LATITUDE", "month"]


@query("write_features", W("""
SELECT CAST(delay_label AS INTEGER) AS delay_label, CAST(month AS INTEGER) AS month, LATITUDE, count(*) AS n,
       round(sum(tavg), 4) AS tavg FROM clean WHERE LATITUDE IS NOT NULL GROUP BY ALL"""))
def q_write_features(spark, sf):
    """The published feature table, summed by the inputs that are read back from its vectors."""
    from delaylake.operators.features import assemble_features
    base = scratch_path(spark, "features")
    TB.publish_features(assemble_features(X.clean(spark, sf), _FEATURES), base)
    v = vector_to_array("features")
    back = read_published(spark, base).select("delay_label", v[3].cast("int").alias("month"),
                                                 v[2].alias("LATITUDE"), v[0].alias("tavg"))
    return back.groupBy(F.col("delay_label").cast("int").alias("delay_label"), "month", "LATITUDE").agg(
        F.count("*").alias("n"), F.round(F.sum("tavg"), 4).alias("tavg"))


_WEATHER_KEYS = ["Dep_Airport", "FlightDate"]


@query("write_clean_table", W(f"""
SELECT {QM.KS}, f.Dep_Airport, f.FlightDate, f.Airline, f.Arr_Delay, CAST(w.tavg AS DOUBLE) AS tavg,
       CAST(w.prcp AS DOUBLE) AS prcp
FROM f_anti f LEFT JOIN weather w ON w.airport_id = f.Dep_Airport AND w."time" = f.FlightDate"""))
def q_write_clean_table(spark, sf):
    """Flights stored by the keys of the anti join, joined from there, stored by the keys of the
    weather join, and joined from there: the flights are read in the order of the join each time."""
    base = scratch_path(spark, "stored")
    f = X.flights(spark, sf).select(*QM.KEY, *K.CANCEL_KEYS, "Dep_Airport", "Arr_Delay")
    by_tail = write_clean_table(f, base, {"by_tail": K.CANCEL_KEYS})["by_tail"]
    left = J.cancel_anti_join(by_tail, X.cancelled(spark, sf))
    write_clean_table(left, base, {"by_day": _WEATHER_KEYS})
    j = J.join_daily_weather(open_stored(spark, f"{base}/by_day"), X.weather(spark, sf))
    return j.select(*QM.KEY, "Dep_Airport", "FlightDate", "Airline", "Arr_Delay",
                    *[F.col(c).cast("double").alias(c) for c in ("tavg", "prcp")])


_IO_NUMERIC = [*K.WEATHER_COLS, "month"]


@query("model_pipeline_io", W(f"""
SELECT {QM.KS}, CASE WHEN Arr_Delay > 15 THEN 1 ELSE 0 END AS delay_label, month,
       round(coalesce(CAST(prcp AS DOUBLE), (SELECT sum(prcp) / count(prcp) FROM rows_ WHERE {QM._bucket_sql(QM.KEY)} < 8000)), 6)
         AS prcp, true AS same_prediction
FROM rows_ WHERE {QM._bucket_sql(QM.KEY)} >= 8000""",
                              ctes=(("rows_", """
SELECT f.*, CAST(month(f.FlightDate) AS INTEGER) AS month, w.prcp FROM flights f
LEFT JOIN weather w ON w.airport_id = f.Dep_Airport AND w."time" = f.FlightDate WHERE Arr_Delay IS NOT NULL"""),)))
def q_model_pipeline_io(spark, sf):
    """Fill, encoding and trees as one pipeline, fitted on the training side, published, loaded
    and applied to the other side as requests are: with the training means, whatever readings
    the requests have."""
    rows = X.f_weather(spark, sf).where("Arr_Delay is not null").select(
        *QM.KEY, *QM.CATS, *K.WEATHER_COLS, F.month("FlightDate").alias("month"), "Arr_Delay")
    train, test = S.split_train_test(materialize(rows, "pipeline-rows"), QM.KEY)
    fill = TrainingFill(means=K.WEATHER_COLS, label=["Arr_Delay", "delay_label", K.DELAY_THRESHOLD_MIN])
    trees = GBTClassifier(labelCol="delay_label", featuresCol="features", maxIter=3, maxDepth=3, seed=K.SEED)
    model = Pipeline(stages=[fill, *M.encode_stages(numeric=_IO_NUMERIC), trees]).fit(M.dealt(train))
    base = scratch_path(spark, "pipeline")
    M.publish_model(model, base)
    p = vector_to_array("probability")[1]
    a = model.transform(test).select(*QM.KEY, "delay_label", "month", F.round("prcp", 6).alias("prcp"), p.alias("p"))
    b = M.load_published(base).transform(test).select(*QM.KEY, p.alias("q"))
    return a.join(b, QM.KEY).select(*QM.KEY, "delay_label", "month", "prcp",
                                    (F.col("p") == F.col("q")).alias("same_prediction"))


@query("model_fallback", W(f"""
SELECT {QM.KS}, '{K.MODEL_NAMES["svm"]}' AS model_used, true AS same_probability
FROM clean WHERE {QM._bucket_sql(QM.KEY)} >= 8000"""))
def q_model_fallback(spark, sf):
    """The tree model's write is cut off before it is published, so requests are scored with the
    second model, and as the one that was saved."""
    train, test = QM._split(spark, sf)
    svm = QM.svm_model(spark, sf)
    base = scratch_path(spark, "models")
    QM.gbt_model(spark, sf).stages[0].write().save(f"{base}/gbt/_v-half/stages/0")
    M.publish_model(svm, f"{base}/svm")
    loaded, name = M.load_first_published([(f"{base}/gbt", K.MODEL_NAMES["gbt"]), (f"{base}/svm", K.MODEL_NAMES["svm"])])
    p = vector_to_array("probability")[1]
    a = svm.transform(test).select(*QM.KEY, p.alias("p"))
    b = loaded.transform(test).select(*QM.KEY, p.alias("q"))
    return a.join(b, QM.KEY).select(*QM.KEY, F.lit(name).alias("model_used"),
                                    (F.abs(F.col("p") - F.col("q")) < 1e-12).alias("same_probability"))

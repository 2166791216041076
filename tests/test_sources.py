import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylake.operators import projection as P
from delaylake.sources import log as LOG
from delaylake.sources import tables as TB
from tests.conftest import rows


def test_read_csv_table_bom_and_padded_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "airports.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:      # UTF-8 BOM
        fh.write(" IATA_CODE , LATITUDE , LONGITUDE \n")
        fh.write("ABE, 40.65 ,-75.44\n")
        fh.write("XYZ,not-a-number,1\n")
    df = TB.read_csv_table(spark, p, TB.COORDS_SCHEMA)
    assert df.columns == ["IATA_CODE", "LATITUDE", "LONGITUDE"]
    assert rows(df) == [("ABE", 40.65, -75.44), ("XYZ", None, 1.0)]


def _csv(folder, name, text, encoding="utf-8"):
    p = os.path.join(folder, name)
    with open(p, "w", encoding=encoding) as fh:
        fh.write(text)
    return p


def test_read_csv_table_matches_columns_by_name(spark, tmp_dir):
    p = _csv(tmp_dir, "c.csv", "Cancelled, FlightDate ,Airline,Tail_Number\n1,2023-01-01,AA,N1\n")
    df = TB.read_csv_table(spark, p, TB.CANCELLED_SCHEMA)
    assert df.columns == ["FlightDate", "Airline", "Tail_Number"]
    assert rows(df) == [("2023-01-01", "AA", "N1")]
    assert rows(TB.read_csv_table(spark, p, TB.CANCELLED_SCHEMA, columns=["Airline"])) == [("AA",)]


def test_read_csv_table_refuses_a_missing_column_and_mixed_headers(spark, tmp_dir):
    p = _csv(tmp_dir, "c.csv", "FlightDate,Airline\n2023-01-01,AA\n")
    with pytest.raises(ValueError, match="Tail_Number"):
        TB.read_csv_table(spark, p, TB.CANCELLED_SCHEMA)
    a = _csv(tmp_dir, "a.csv", "FlightDate,Airline,Tail_Number\n2023-01-01,AA,N1\n")
    b = _csv(tmp_dir, "b.csv", "Airline,FlightDate,Tail_Number\nBB,2023-01-02,N2\n")
    with pytest.raises(Exception, match="(?i)header"):
        TB.read_csv_table(spark, [a, b], TB.CANCELLED_SCHEMA).collect()


def test_read_csv_table_keeps_and_counts_rejects(spark, tmp_dir):
    p = _csv(tmp_dir, "x.csv", "LONGITUDE,IATA_CODE,LATITUDE\n-75.4,ABE,40.6\n1,XYZ,bad\n2,QQQ\n", "utf-8-sig")
    df = TB.read_csv_table(spark, p, TB.COORDS_SCHEMA)
    assert sorted(r[0] for r in df.collect()) == ["ABE", "QQQ", "XYZ"]
    bad = TB.csv_rejects(spark, p, TB.COORDS_SCHEMA)
    assert bad.count() == 2
    assert sorted(r["_rejected"] for r in bad.collect()) == ["1,XYZ,bad", "2,QQQ"]


def test_read_csv_pruned(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.csv")
    with open(p, "w") as fh:
        fh.write("time,tavg,tmin,tmax,prcp,snow,wdir,wspd,wpgt,pres,tsun,airport_id\n")
        fh.write("2023-01-01,1.5,,,0.2,,,9,,1012,,ABE\n")
    df = TB.read_csv_table(spark, p, TB.WEATHER_SCHEMA, columns=["airport_id", "time", "tavg"])
    assert rows(df) == [("ABE", "2023-01-01", 1.5)]


def test_read_json_array_records(spark, tmp_dir):
    p = os.path.join(tmp_dir, "monthly.json")
    with open(p, "w") as fh:
        json.dump([{"Month": "Jan", "Average_Arrival_Delay_Minutes": 8.33},
                   {"Month": "Feb", "Average_Arrival_Delay_Minutes": 6.65}], fh)
    schema = T.StructType([T.StructField("Month", T.StringType()),
                           T.StructField("Average_Arrival_Delay_Minutes", T.DoubleType())])
    df = TB.read_json_array(spark, p, schema)
    assert rows(df) == [("Feb", 6.65), ("Jan", 8.33)]


def test_write_table_and_lookups(spark, tmp_dir):
    df = spark.createDataFrame([("ABE", 0.1)], "Dep_Airport string, dep_airport_delay_avg double")
    TB.write_lookups({"delay": df}, tmp_dir, fmt="csv")
    back = TB.read_csv_table(spark, os.path.join(tmp_dir, "delay"), TB.DELAY_LOOKUP_SCHEMA)
    assert rows(back) == [("ABE", 0.1)]
    TB.write_table(df, os.path.join(tmp_dir, "p"), partition_by=["Dep_Airport"])
    assert os.path.isdir(os.path.join(tmp_dir, "p", "Dep_Airport=ABE"))


def test_write_features(spark, tmp_dir):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 1, "x")],
                               ["features", "delay_label", "o"])
    TB.write_features(df, os.path.join(tmp_dir, "f"))
    back = spark.read.parquet(os.path.join(tmp_dir, "f"))
    assert back.columns == ["features", "delay_label"]


def test_append_log_and_history(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    first = spark.createDataFrame(
        [(t0 + dt.timedelta(minutes=i), "flask", 10.0 * i, "low") for i in range(3)],
        "timestamp timestamp, source string, delay_prob double, risk string")
    LOG.append_prediction_log(first, path)
    second = spark.createDataFrame(
        [(t0 + dt.timedelta(days=1), None, 55.0, None)],
        "timestamp timestamp, source string, delay_prob double, risk string")
    LOG.append_prediction_log(second, path)
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert "log_date" in log.columns and "weather" in log.columns
    latest = LOG.prediction_history(log, 2).collect()
    assert [r["delay_prob"] for r in latest] == [55.0, 20.0]
    disp = LOG.history_display(log).where(F.col("delay_prob") == 55.0).collect()[0]
    assert (disp["source"], disp["risk"], disp["risk_label"], disp["route"]) == \
        ("flask", "low", "ON TIME", "—")


def test_rename_select_prefix(spark):
    df = spark.createDataFrame([("ABE", 1.0, 2.0)], "IATA_CODE string, LATITUDE double, LONGITUDE double")
    r = P.rename_key(df)
    assert r.columns[0] == "Dep_Airport"
    assert P.select_available(r, ["LONGITUDE", "missing", "Dep_Airport"]).columns == \
        ["LONGITUDE", "Dep_Airport"]
    d = spark.createDataFrame([(1, 0, 1)], "Airline_AA int, DepTime_label_Night int, k int")
    assert P.prefix_columns(d, ["Airline_", "DepTime_label_"]) == ["Airline_AA", "DepTime_label_Night"]
    assert P.align_columns(d, ["k", "Airline_BB"]).collect()[0] == (1, 0)
    assert P.drop_leakage(spark.createDataFrame([(1, 2)], "Arr_Delay int, k int")).columns == ["k"]


def test_load_checked_counts_in_the_pass_that_writes(spark, tmp_dir):
    p = _csv(tmp_dir, "x.csv", "LONGITUDE,IATA_CODE,LATITUDE\n-75.4,ABE,40.6\n1,XYZ,bad\n2,QQQ\n3,OK,1.0\n", "utf-8-sig")
    got = TB.load_checked(TB.read_csv_table(spark, p, TB.COORDS_SCHEMA, rejected=True), os.path.join(tmp_dir, "out"))
    assert (got.n_read, got.n_rejected) == (4, 2)
    assert rows(got.rows) == [("ABE", 40.6, -75.4), ("OK", 1.0, 3.0)]
    assert sorted(r["_rejected"] for r in got.rejects.collect()) == ["1,XYZ,bad", "2,QQQ"]
    none = _csv(tmp_dir, "none.csv", "IATA_CODE,LATITUDE,LONGITUDE\n")
    got = TB.load_checked(TB.read_csv_table(spark, none, TB.COORDS_SCHEMA, rejected=True), os.path.join(tmp_dir, "none"))
    assert (got.n_read, got.n_rejected, got.rows.count(), got.rejects.count()) == (0, 0, 0, 0)


def test_json_rejects_of_lines_and_arrays(spark, tmp_dir):
    lines = _csv(tmp_dir, "a.json", '{"k": 1, "v": "x"}\n{"k": "no number", "v": "y"}\n{"k": 3, "v"\nnot json\n\n{"k": 4}\n')
    df = TB.read_json_records(spark, lines, "k int, v string", rejected=True)
    good = [tuple(r) for r in df.where("_rejected is null").select("k", "v").orderBy("k").collect()]
    assert good == [(1, "x"), (4, None)]
    assert sorted(r["_rejected"] for r in df.collect() if r["_rejected"] is not None) == [
        "not json", '{"k": "no number", "v": "y"}', '{"k": 3, "v"']
    assert TB.read_json_records(spark, lines, "k int, v string").columns == ["k", "v"]
    os.makedirs(os.path.join(tmp_dir, "arrays"))
    _csv(os.path.join(tmp_dir, "arrays"), "a.json", '[{"k": 1, "v": "x"},\n {"k": 2}]')
    _csv(os.path.join(tmp_dir, "arrays"), "b.json", '[{"k": 7}, {"k": ')
    df = TB.read_json_array(spark, os.path.join(tmp_dir, "arrays"), "k int, v string", rejected=True)
    got = df.collect()
    assert sorted(r["k"] for r in got if r["_rejected"] is None) == [1, 2]
    assert sum(r["_rejected"] is not None for r in got) == 1

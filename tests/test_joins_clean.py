import datetime as dt

import pytest

from delaylake.operators import aggregates as A
from delaylake.operators import clean as CL
from delaylake.operators import joins as J
from delaylake.operators import projection as P
from tests.conftest import rows

D1 = dt.date(2023, 1, 1)
D2 = dt.date(2023, 1, 2)
FSCHEMA = "id int, FlightDate date, Airline string, Tail_Number string"


@pytest.fixture()
def flights(spark):
    return spark.createDataFrame([
        (1, D1, "AA", "N1"),     # cancelled tail-day: goes
        (2, D1, "AA", "N1"),     # second flight of the same tail that day: goes too
        (3, D1, "AA", None),     # null tail
        (4, D2, "AA", "N1"),     # other day: stays
    ], FSCHEMA)


@pytest.fixture()
def cancelled(spark):
    return spark.createDataFrame([
        (D1, "AA", "N1"), (D1, "AA", "N1"),   # duplicate cancelled row
        (D1, "AA", None),
    ], "FlightDate date, Airline string, Tail_Number string")


def test_cancel_anti_join_spark_semantics(flights, cancelled):
    got = rows(J.cancel_anti_join(flights, cancelled), "id")
    assert got == [(3,), (4,)]          # null key never matches


def test_cancel_anti_join_null_safe(flights, cancelled):
    got = rows(J.cancel_anti_join(flights, cancelled, null_safe=True), "id")
    assert got == [(4,)]                # null matches null


def test_join_daily_weather_rejects_duplicate_keys(spark):
    f = spark.createDataFrame([(1, "AAA", D1), (2, "BBB", D1)], "id int, Dep_Airport string, FlightDate date")
    w = spark.createDataFrame([("AAA", D1, 5.0), ("AAA", D1, 7.0), ("CCC", D1, 1.0)],
                              "airport_id string, time date, tavg double")
    j = J.join_daily_weather(f, w)
    assert j.count() == 2               # no multiplication
    assert rows(j, "id", "tavg") == [(1, 5.0), (2, None)]
    assert "airport_id" not in j.columns and "time" not in j.columns


def test_route_estimate_cases(spark):
    coords = spark.createDataFrame([("AAA", 40.0, -100.0), ("BBB", 40.0, -100.0),
                                    ("CCC", 40.0, -88.41), ("DDD", 40.0, -78.27)],
                                   "IATA_CODE string, LATITUDE double, LONGITUDE double")
    req = spark.createDataFrame([
        ("1", "AAA", "AAA"),     # same airport -> 0 miles -> 30 min floor
        ("2", "ZZZ", "AAA"),     # unknown departure -> (39, -98)
        ("3", "AAA", "ZZZ"),     # unknown arrival -> (41.9, -87.9)
        ("4", "AAA", "CCC"),     # 11.59 deg -> 799.7 mi: short
        ("5", "AAA", "DDD"),     # 21.73 deg -> 1499.4 mi: medium
    ], "request_id string, dep_airport string, arr_airport string")
    got = {r[0]: r[1:] for r in J.route_estimate(req, coords)
           .select("request_id", "flight_duration", "route_type", "est_distance").collect()}
    assert got["1"][0] == 30 and got["1"][2] == 0.0
    assert got["2"][2] == pytest.approx(69 * ((39 - 40) ** 2 + (-98 + 100) ** 2) ** 0.5)
    assert got["3"][2] == pytest.approx(69 * ((41.9 - 40) ** 2 + (-87.9 + 100) ** 2) ** 0.5)
    assert got["4"][1] == "Short Haul >1500Mi" and got["4"][2] < 800
    assert got["5"][1] == "Medium Haul <3000Mi" and 800 <= got["5"][2] < 1500
    assert got["5"][0] == int(got["5"][2] // 8)


def test_lookup_defaults(spark):
    req = spark.createDataFrame([("1", "AAA", "BBB", 1), ("2", "ZZZ", "AAA", 2)],
                                "request_id string, dep_airport string, arr_airport string, req_month int")
    wavg = spark.createDataFrame([("AAA", 1, 3.0, 0.5, 9.0, 1010.0)],
                                 "airport_id string, month int, tavg double, prcp double, wspd double, pres double")
    w = rows(J.lookup_weather_default(req, wavg), "request_id", "tavg", "prcp", "wspd", "pres")
    assert w == [("1", 3.0, 0.5, 9.0, 1010.0), ("2", 15.0, 2.0, 15.0, 1013.0)]
    rates = spark.createDataFrame([("AAA", 0.3)], "Dep_Airport string, dep_airport_delay_avg double")
    d = rows(J.lookup_delay_default(req, rates), "request_id", "dep_airport_delay_avg",
             "arr_airport_delay_avg")
    assert d == [("1", 0.3, 0.2), ("2", 0.2, 0.3)]
    coords = spark.createDataFrame([("AAA", 40.0, -100.0)], "IATA_CODE string, LATITUDE double, LONGITUDE double")
    c = rows(J.lookup_coords_default(req, coords), "request_id", "LATITUDE", "LONGITUDE")
    assert c == [("1", 40.0, -100.0), ("2", 39.0, -98.0)]


def test_impute_group_mean_then_median(spark):
    df = spark.createDataFrame([
        (1, "AAA", None), (2, "AAA", None),          # airport with all null
        (3, "BBB", 4.0), (4, "BBB", None),           # one value
        (5, "CCC", 1.0), (6, "CCC", 3.0),            # no nulls
    ], "id int, Dep_Airport string, tavg double")
    g = rows(CL.impute_group_mean(df, ["tavg"]), "id", "tavg")
    assert g == [(1, None), (2, None), (3, 4.0), (4, 4.0), (5, 1.0), (6, 3.0)]
    m = rows(CL.impute_group_then_median(df, ["tavg"]), "id", "tavg")
    # median of the group-filled column (4, 4, 1, 3) = 3.5
    assert m == [(1, 3.5), (2, 3.5), (3, 4.0), (4, 4.0), (5, 1.0), (6, 3.0)]


def test_impute_global_mean_exact_on_decimals(spark):
    df = spark.createDataFrame([(1, "0.10"), (2, "0.20"), (3, None)], "id int, s string") \
              .selectExpr("id", "cast(s as decimal(10,2)) as prcp")
    got = rows(CL.impute_global_mean(df, ["prcp"]), "id", "prcp")
    assert got == [(1, 0.1), (2, 0.2), (3, 0.15)]     # exact decimal sum / count


def test_dedup_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert CL.dedup_rows(df).count() == 2


def test_route_stats_median_and_mode(spark):
    df = spark.createDataFrame([
        ("A", "B", 10, "X"), ("A", "B", 20, "Y"),                      # tied mode -> X; median 15
        ("A", "C", 7, "Z"),                                            # single row
        ("B", "C", 1, "X"), ("B", "C", 2, "X"), ("B", "C", 3, None), ("B", "C", 9, "Y"),
        (None, "C", 5, "X"),                                           # null key dropped
    ], "Dep_Airport string, Arr_Airport string, Flight_Duration int, Distance_type string")
    got = rows(A.route_stats(df))
    assert got == [("A", "B", 15.0, "X"), ("A", "C", 7.0, "Z"), ("B", "C", 2.5, "X")]


def test_fill_constants_does_not_truncate_int(spark):
    df = spark.createDataFrame([(None,), (3,)], "Aicraft_age int")
    got = [r[0] for r in P.fill_constants(df, {"Aicraft_age": 2.9}).collect()]
    assert got == [2.9, 3.0]


def test_validate_requests_rejects_blank_fields(spark):
    df = spark.createDataFrame([
        ("1", " AA ", " ord ", "jfk", "2023-01-01", None),
        ("2", "  ", "ORD", "JFK", "2023-01-01", "Night"),
        ("3", "AA", "ORD", "", "2023-01-01", "Night"),
    ], "request_id string, airline_key string, dep_airport string, arr_airport string, "
       "travel_date string, dep_time string")
    valid, rejected = P.validate_requests(df)
    assert rows(valid, "request_id", "airline_key", "dep_airport", "arr_airport", "dep_time") == \
        [("1", "AA", "ORD", "JFK", "Morning")]
    assert rows(rejected, "request_id", "reject_reason") == \
        [("2", "missing airline"), ("3", "missing arrival airport")]


def test_parse_travel_date_fallback(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2023-13-45",), ("",), (None,)], "travel_date string")
    got = [tuple(r) for r in P.parse_travel_date(df).drop("travel_date").collect()]
    assert got[0] == (1, 1, 7, "Sunday", True)
    assert got[1:] == [(1, 1, 1, "Monday", False)] * 3


def test_target_rates_from_training_rows_only(spark):
    rows_ = [(i, "AAA" if i < 6 else "BBB", "CCC", 1 if i % 2 == 0 else 0) for i in range(10)]
    f = spark.createDataFrame(rows_, "id int, Dep_Airport string, Arr_Airport string, delay_label int")
    train = f.where("id < 4")
    j = J.join_target_rates(f, rates_source=train)
    got = {r["id"]: (r["dep_airport_delay_avg"], r["arr_airport_delay_avg"]) for r in j.collect()}
    assert got[0] == (0.5, 0.5) and got[9] == (None, 0.5)   # BBB unseen in training rows
    leak = {r["id"]: r["dep_airport_delay_avg"] for r in J.join_target_rates(f).collect()}
    assert leak[0] == 0.5 and leak[9] == 0.5


def test_quantile_exact_and_approx(spark):
    df = spark.range(1001).selectExpr("cast(id as double) as x")
    ex = A.quantile_bounds(df, "x", (0.02, 0.98)).collect()[0]
    assert tuple(ex) == (20.0, 980.0)
    ap = A.quantile_bounds(df, "x", (0.02, 0.98), exact=False).collect()[0]
    assert abs(ap[0] - 20.0) <= 2 and abs(ap[1] - 980.0) <= 2
    med = CL.impute_global_median(
        df.selectExpr("case when x < 3 then null else x end as x"), ["x"], exact=False)
    assert med.where("x is null").count() == 0

import datetime as dt

from delaylake.functions import columns as C


def one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_delay_label_threshold_and_null(spark):
    df = one_col(spark, [15, 16, None], "int")
    got = [r[0] for r in df.select(C.delay_label("x")).collect()]
    assert got == [0, 1, 0]


def test_clip_keeps_null_and_bounds(spark):
    df = one_col(spark, [None, -40, -30, 0, 300, 500], "int")
    got = [r[0] for r in df.select(C.clip("x", -30, 300)).collect()]
    assert got == [None, -30, -30, 0, 300, 300]
    lower = [r[0] for r in df.select(C.clip("x", lo=0)).collect()]
    assert lower == [None, 0, 0, 0, 300, 500]


def test_risk_bracket_edges(spark):
    df = one_col(spark, [0.2499, 0.25, 0.3999, 0.40, None], "double")
    got = [tuple(r[0]) if r[0] is not None else None
           for r in df.select(C.risk_bracket("x")).collect()]
    assert [g[0] for g in got] == ["low", "medium", "medium", "high", None]
    assert got[3][1] == "DELAYED" and got[1][1] == "POSSIBLY DELAYED" and got[0][1] == "ON TIME"


def test_temp_band_half_even_and_rain_band(spark):
    df = one_col(spark, [1.0, 3.0, 5.0, -1.0, 1.99, 2.0], "double")
    t = [r[0] for r in df.select(C.temp_band("x")).collect()]
    # t/2 = 0.5, 1.5, 2.5, -0.5 round half to even -> 0, 2, 2, -0
    assert t == [0, 4, 4, 0, 2, 2]
    r = [r[0] for r in df.select(C.rain_band("x")).collect()]
    assert r == [0, 2, 4, -2, 0, 2]


def test_to_date_lenient(spark):
    df = one_col(spark, ["2023-01-01", "2023-13-45", "", None], "string")
    got = [r[0] for r in df.select(C.to_date_lenient("x", "yyyy-MM-dd")).collect()]
    assert got == [dt.date(2023, 1, 1), None, None, None]


def test_to_number_lenient(spark):
    df = one_col(spark, ["12", "abc", None], "string")
    assert [r[0] for r in df.select(C.to_number_lenient("x")).collect()] == [12.0, None, None]


def test_percent_fields_half_even(spark):
    df = one_col(spark, [0.125, 0.5], "double")
    got = [tuple(r) for r in df.select(*C.percent_fields("x")).collect()]
    assert got == [(12.5, 87.5), (50.0, 50.0)]


def test_confidence_threshold_is_strict(spark):
    df = one_col(spark, [0.6, 0.61, None], "double")
    assert [r[0] for r in df.select(C.confidence_threshold("x")).collect()] == [0, 1, None]


def test_airline_display_maps_and_passes_through(spark):
    df = one_col(spark, ["Spirit Air Lines", "Unknown Air"], "string")
    got = [r[0] for r in df.select(C.airline_display("x")).collect()]
    assert got == ["NK — Spirit Air Lines", "Unknown Air"]


def test_md5_bucket_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    a = [r[0] for r in df.select(C.md5_bucket(C.hash_key(["k", "v"]))).collect()]
    b = [r[0] for r in df.repartition(3).orderBy("k")
         .select(C.md5_bucket(C.hash_key(["k", "v"]))).collect()]
    assert a == b and all(0 <= x < 10000 for x in a)


def test_weekend_and_delay_level(spark):
    df = one_col(spark, [5, 6, 7, None], "int")
    assert [r[0] for r in df.select(C.weekend_flag("x")).collect()] == [0, 1, 1, 0]
    lv = one_col(spark, [14.81, 15.0, 16.11, None], "double")
    assert [r[0] for r in lv.select(C.delay_level("x")).collect()] == ["Low", "Medium", "Medium", None]

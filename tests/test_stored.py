"""Tables stored in the layout of their joins."""

import os
import random

import pytest
from pyspark.sql import functions as F

from delaylake.functions import constants as K
from delaylake.operators import joins as J
from delaylake.sources.stored import open_stored, store, write_clean_table


def left_of(plan, join):
    """Operators on the left side of a join in an executed plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if join in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    own, out = depth(lines[at]), []
    first = depth(lines[at + 1])
    for line in lines[at + 1:]:
        if depth(line) <= own or (depth(line) == first and out):
            break
        out.append(line)
    return "\n".join(out)


def tables(spark, seed=1):
    rnd = random.Random(seed)
    flights = [(i, f"2023-01-{1 + rnd.randrange(9):02d}", rnd.choice("ABC"), rnd.choice([None, "1", "2"]), rnd.choice("XYZ"))
               for i in range(3000)]
    cancelled = [(d, a, t) for _, d, a, t, _ in flights[::37]] * 2
    weather = [(a, f"2023-01-{d:02d}", float(d)) for a in "XY" for d in range(1, 9)]
    return (spark.createDataFrame(flights, "k int, FlightDate string, Airline string, Tail_Number string, Dep_Airport string"),
            spark.createDataFrame(cancelled, "FlightDate string, Airline string, Tail_Number string"),
            spark.createDataFrame(weather, "airport_id string, time string, tavg double"))


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_joins_on_the_stored_keys_have_no_exchange_of_the_flights(spark, tmp_dir, no_broadcast):
    f, c, w = tables(spark)
    layouts = {"by_tail": K.CANCEL_KEYS, "by_day": ["Dep_Airport", "FlightDate"]}
    write_clean_table(f, tmp_dir, layouts)
    anti = J.cancel_anti_join(open_stored(spark, os.path.join(tmp_dir, "by_tail")), c)
    joined = J.join_daily_weather(open_stored(spark, os.path.join(tmp_dir, "by_day")), w)
    for df, plain in ((anti, J.cancel_anti_join(f, c)), (joined, J.join_daily_weather(f, w))):
        assert sorted(map(tuple, df.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        plan = df._jdf.queryExecution().executedPlan().toString()
        side = left_of(plan, "SortMergeJoin")
        assert "Bucketed: true" in side and "Exchange" not in side, plan
        other = left_of(plain._jdf.queryExecution().executedPlan().toString(), "SortMergeJoin")
        assert "Exchange" in other


def test_stored_table_keeps_rows_types_and_odd_names(spark, tmp_dir):
    df = spark.range(500).select("id", (F.col("id") % 3).cast("decimal(9,2)").alias("d e"), F.lit(None).cast("date").alias("x"))
    got = store(df, os.path.join(tmp_dir, "t"), ["id"], buckets=3, spread=2)
    again = open_stored(spark, os.path.join(tmp_dir, "t"))
    for t in (got, again):
        assert t.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, t.collect())) == sorted(map(tuple, df.collect()))
    empty = store(df.limit(0), os.path.join(tmp_dir, "none"), ["id"])
    assert empty.collect() == [] and open_stored(spark, os.path.join(tmp_dir, "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        open_stored(spark, os.path.join(tmp_dir, "missing"))

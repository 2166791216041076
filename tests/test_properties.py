"""Property-based checks of operators against plain-Python references."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from delaylake.functions import columns as C
from delaylake.operators import evaluate as E
from delaylake.operators import sampling as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=1, max_size=50),
       lo=st.integers(-500, 0), width=st.integers(0, 800))
def test_clip_matches_python(spark, values, lo, width):
    hi = lo + width
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = [r[0] for r in df.select(C.clip("x", lo, hi)).collect()]
    assert got == [None if v is None else min(max(v, lo), hi) for v in values]


@SETTINGS
@given(cents=st.lists(st.integers(-4500, 4500), min_size=1, max_size=50))
def test_temp_band_matches_python_round(spark, cents):
    # temperatures with 2 decimals, as in the weather table
    xs = [c / 100 for c in cents]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(C.temp_band("x")).collect()]
    assert got == [int(round(x / 2) * 2) for x in xs]


@SETTINGS
@given(keys=st.lists(st.text(min_size=0, max_size=8), min_size=1, max_size=30))
def test_md5_bucket_matches_hashlib(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(C.md5_bucket(C.hash_key(["k"]))).collect()]
    want = [int(hashlib.md5(f"{k}|42".encode()).hexdigest()[:8], 16) % 10000 for k in keys]
    assert got == want


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 3)), min_size=1, max_size=80),
       n=st.integers(0, 90))
def test_first_n_by_hash_with_duplicates(spark, data, n):
    df = spark.createDataFrame(data, "a int, b int").repartition(3)
    nt = spark.createDataFrame([(n,)], "__n bigint")
    got = sorted(tuple(r) for r in S.first_n_by_hash(df, ["a", "b"], nt).collect())

    def h(k):
        return int(hashlib.md5(f"{k[0]}|{k[1]}|42".encode()).hexdigest()[:15], 16)
    assert got == sorted(sorted(data, key=lambda k: (h(k), k))[:n])


@SETTINGS
@given(vals=st.lists(st.integers(0, 9), min_size=1, max_size=60), parts=st.integers(1, 5))
def test_running_sum_before_matches_prefix_sums(spark, vals, parts):
    df = spark.createDataFrame(list(enumerate(vals)), "o int, v int").repartition(parts)
    got = {r["o"]: r["s"] for r in E.running_sum_before(df, "o", "v", "s").collect()}
    assert [got[i] for i in range(len(vals))] == [sum(vals[:i]) for i in range(len(vals))]

"""The dashboard's mergeable state equals a rebuild, for any split of the rows into batches."""

import os

import pytest
from pyspark.sql import functions as F

from delaylake.operators import aggregates as A
from delaylake.plans import fixtures as X
from delaylake.plans import state as ST
from delaylake.plans.dashboard import dashboard_tables
from delaylake.plans.etl import materialize
from delaylake.sources.views import FLIGHT_KEY
from tests.conftest import SF001, rows

KEY = list(FLIGHT_KEY)


def _r(rs):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rs]


def same(got, want):
    for name, df in want.items():
        cols = sorted(df.columns)
        assert sorted(got[name].columns) == cols, name
        # both trends average interpolated bounds, whose sums depend on the order in the last bit
        exact = _r if name.endswith("_trend") else (lambda x: x)
        assert exact(rows(got[name], *cols)) == exact(rows(df, *cols)), name


@pytest.fixture(scope="module")
def tables(spark):
    clean = materialize(X.clean(spark, SF001).unionByName(X.clean(spark, SF001).where("l_linenumber = 1").withColumns(
        {"Airline": F.lit(None).cast("string"), "tavg": F.lit(None).cast("double"), "Arr_Delay": F.lit(None).cast("int")})), "c")
    airports = X.airports(spark, SF001)
    return clean, airports, dashboard_tables(clean, airports, KEY)


@pytest.mark.parametrize("split", ["dayofmonth(FlightDate) % 4", "cast(FlightDate < '1995-03-01' as int)", "l_partkey % 3"])
def test_merged_batches_equal_a_rebuild(spark, tables, tmp_dir, split):
    clean, airports, want = tables
    parts = [r[0] for r in clean.select(F.expr(split)).distinct().collect()]
    for p in parts:
        ST.add_batch(spark, tmp_dir, f"b{p}", clean.where(F.expr(split) == p), KEY)
    got = ST.dashboard_from_state(spark, tmp_dir, airports, KEY)
    same(got, want)
    assert _r(rows(got["overall"])) == _r(rows(A.overall_stats(clean)))


def test_a_batch_added_again_replaces_itself_and_an_empty_one_changes_nothing(spark, tables, tmp_dir):
    clean, airports, want = tables
    late = F.col("l_linenumber") > 4
    ST.add_batch(spark, tmp_dir, "a", clean, KEY)                   # too much, replaced below
    ST.add_batch(spark, tmp_dir, "a", clean.where(~late), KEY)
    ST.add_batch(spark, tmp_dir, "b", clean.where(late), KEY)
    ST.add_batch(spark, tmp_dir, "none", clean.limit(0), KEY)
    os.makedirs(os.path.join(tmp_dir, "half", "_v-cut"))            # a batch whose write was cut off
    same(ST.dashboard_from_state(spark, tmp_dir, airports, KEY), {k: want[k] for k in ("monthly_delay", "summary", "top_airlines")})
    with pytest.raises(FileNotFoundError):
        ST.merged(spark, os.path.join(tmp_dir, "half"), KEY)

"""The staged one-pass ETL equals the composed lazy ETL; the pruned label
plan gives the same rates."""

from delaylake.operators import aggregates as A
from delaylake.operators import clean, joins
from delaylake.plans import chains
from delaylake.plans import fixtures as X
from tests.conftest import SF001, rows


def _r(rs):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rs]


def test_staged_etl_equals_composed(spark):
    a = X.clean(spark, SF001, stage=False)
    b = X.clean(spark, SF001, stage=True)
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert _r(rows(a, *cols)) == _r(rows(b, *cols))
    assert "Day_Of_Week" not in a.columns and "day_of_week" in a.columns


def test_labelled_rows_give_clean_rates(spark):
    c = A.delay_rate(X.clean(spark, SF001))
    l_ = A.delay_rate(X.labelled(spark, SF001))
    assert _r(rows(c)) == _r(rows(l_))
    assert X.labelled(spark, SF001).count() == X.clean(spark, SF001).count()


def test_clean_rows_are_exchanged_by_part_and_order_only(spark):
    """Where no side is small enough for the planner's own broadcast, the flights move for the
    joins on part and order; duplicates, cancelled keys, airports and weather move them no more."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        f = clean.dedup_rows(X.flights(spark, SF001))
        f = joins.cancel_anti_join(f, X.cancelled(spark, SF001))
        f = joins.join_airport_coords(f, X.airports(spark, SF001))
        f = joins.join_daily_weather(f, X.weather(spark, SF001))
        plan = f._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # lineitem and part by part; orders and customer by customer; both results by order
    flights = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "IATA" not in line
               and "Dep_Airport" not in line]
    assert len(flights) == 6, plan
    assert plan.count("BroadcastHashJoin") >= 5, plan


def test_stacked_features_read_the_written_joins(spark):
    """Means, medians, codes and rows are taken from the joined flights written once."""
    f = X.flights(spark, SF001)
    out = chains.stacked_features([f], X.cancelled(spark, SF001), X.airports(spark, SF001), X.weather(spark, SF001),
                                  {"DepTime_label": ["1-URGENT", "2-HIGH"]})
    assert not any("lineitem" in p for p in out.inputFiles())

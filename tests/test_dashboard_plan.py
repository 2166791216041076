"""The one-pass dashboard (grouping sets) equals the per-table operators."""

from delaylake.operators import dashboard as D
from delaylake.plans import fixtures as X
from delaylake.plans.dashboard import dashboard_tables
from delaylake.plans.etl import materialize
from delaylake.sources.views import FLIGHT_KEY
from tests.conftest import SF001, rows


def _r(rs):
    """Doubles to 9 decimals: sums of doubles may differ in the last bit with
    the partial-aggregation order."""
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rs]


def test_dashboard_tables_match_operators(spark):
    clean = materialize(X.clean(spark, SF001), "test-clean")
    airports = X.airports(spark, SF001)
    got = dashboard_tables(clean, airports, list(FLIGHT_KEY))
    heat = D.delay_heatmap(clean.withColumn("DepTime_label", X.slot_label()))
    scatter = D.rain_delay_scatter(clean)
    expect = {
        "monthly_delay": D.monthly_avg_delay(clean),
        "monthly_delay_count": D.monthly_delay_count(clean),
        "top_airlines": D.airline_ranking(clean),
        "airport_map": D.airport_delay_map(clean, airports),
        "delay_heatmap": heat,
        "heatmap_matrix": D.heatmap_pivot(heat),
        "precipitation_scatter": scatter,
        "precipitation_trend": D.rain_delay_trend(scatter),
        "temperature_trend": D.temp_delay_trend(clean),
    }
    for name, df in expect.items():
        assert sorted(got[name].columns) == sorted(df.columns), name
        cols = sorted(df.columns)
        assert _r(rows(got[name], *cols)) == _r(rows(df, *cols)), name
    assert got["summary"].count() == 3
    assert got["temperature_sample"].count() <= 2000


def test_payload_has_every_section(spark):
    import json

    from delaylake.plans.dashboard import payload
    clean = materialize(X.clean(spark, SF001), "test-clean-payload")
    tables = dashboard_tables(clean, X.airports(spark, SF001), list(FLIGHT_KEY))
    p = payload(tables)
    counts = {r[0]: r[1] for r in p.groupBy("section").count().collect()}
    for name, df in tables.items():
        assert counts.get(name, 0) == df.count(), name
    rec = json.loads(p.where("section = 'monthly_delay'").first()["record"])
    assert set(rec) == {"month_num", "Month", "Average_Arrival_Delay_Minutes"}

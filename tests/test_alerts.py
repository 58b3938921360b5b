from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from riskstream.operators import alerts as al
from riskstream.operators import stats as st
from riskstream.schema import ALERT_COLUMNS
from riskstream.sinks.alert_store import STORE_SCHEMA

CLOCK = dt.datetime(2024, 1, 1)


def make_alerts(spark, rows):
    """(id, amount, category, state) rows, each a minute newer than the one before."""
    full = [
        (i, CLOCK + dt.timedelta(minutes=n), float(a) if a is not None else None, "m", c, "4", "f", "l", "M",
         "j", s, "city", "00001", 1.0, CLOCK + dt.timedelta(minutes=n))
        for n, (i, a, c, s) in enumerate(rows)
    ]
    kinds = {f.name: f.dataType.simpleString() for f in STORE_SCHEMA}
    return spark.createDataFrame(full, ", ".join(f"`{c}` {kinds[c]}" for c in ALERT_COLUMNS))


def ids(df):
    return [r.transaction_id for r in df.collect()]


def test_limit_before_or_after_filter(spark):
    alerts = make_alerts(spark, [("old", 1, "travel", "CA"), ("mid", 2, "home", "NY"), ("new", 3, "home", "CA")])
    assert ids(al.list_alerts(alerts, 1, "travel", limit_first=True)) == []
    assert ids(al.list_alerts(alerts, 1, "travel")) == ["old"]
    assert ids(al.list_alerts(alerts, 2)) == ["new", "mid"]
    assert sorted(ids(al.list_alerts(alerts))) == ["mid", "new", "old"]
    assert ids(al.list_alerts(alerts, category="home", state="CA")) == ["new"]
    assert len(ids(al.list_alerts(alerts, category="", state=""))) == 3
    assert ids(al.latest_alerts(alerts, 2)) == ["new", "mid"]


@pytest.mark.parametrize("limit", [0, -1, 100_001])
def test_limit_bounds(spark, limit):
    with pytest.raises(ValueError):
        al.list_alerts(make_alerts(spark, [("a", 1, "c", "s")]), limit)


def test_alert_projection_keeps_positives_and_default_clock(spark, small):
    from riskstream.plans.transactions import transactions, with_rule_prediction

    alerts = al.alert_projection(with_rule_prediction(transactions(spark, small)))
    assert alerts.columns == list(ALERT_COLUMNS)
    assert alerts.filter("amount <= 100 or is_fraud <> 1 or detected_at is null").isEmpty()


def test_empty_statistics(spark):
    none = make_alerts(spark, [("a", 1, "c", "s")]).filter("false")
    assert tuple(st.alert_stats(none).first()) == (0, 0.0, 0.0)
    assert tuple(st.alert_stats_maps(none).first()) == (0, 0.0, 0.0, {}, {})
    assert st.alert_count(none).first()[0] == 0
    assert st.histogram(none, "amount").collect() == []
    assert st.top_states(none).collect() == []


def test_statistics_object(spark):
    alerts = make_alerts(spark, [("a", 1.25, "x", "CA"), ("b", None, None, ""), ("c", 2.5, "x", None)])
    stats = st.alert_stats_maps(alerts).first()
    assert (stats.total_alerts, stats.total_amount, stats.avg_amount) == (3, 3.75, 1.88)
    assert stats.by_category == {"x": 2, "null": 1} and stats.by_state == {"CA": 1}


def test_nan_amount_does_not_fail(spark):
    alerts = make_alerts(spark, [("a", float("nan"), "x", "CA"), ("b", 5.0, "x", "CA")])
    st.alert_stats(alerts).collect(), st.alert_stats_maps(alerts).collect()
    assert [tuple(r) for r in st.histogram(alerts, "amount", 3).select("bin", "n").collect()] == [(0, 1)]
    assert al.display_alerts(alerts).count() == 2


def test_histogram_ends_and_equal_values(spark):
    values = spark.createDataFrame([(float(v),) for v in range(31)], "x double")
    bins = {r.bin: r.n for r in st.histogram(values, "x", 30).collect()}
    assert bins == {b: 1 for b in range(31)}
    same = spark.createDataFrame([(4.0,)] * 5, "x double")
    assert [(r.bin, r.bin_start, r.bin_end, r.n) for r in st.histogram(same, "x").collect()] == [(0, 4.0, 5.0, 5)]


def test_histogram_has_round_and_empty_bins(spark):
    values = spark.createDataFrame([(v,) for v in (-7.0, 3.0, 93.0, float("inf"), float("-inf"), float("nan"), None)], "x double")
    got = [tuple(r) for r in st.histogram(values, "x", 30).orderBy("bin").collect()]
    assert len(got) == 21 and got[0] == (0, -10.0, -5.0, 1) and got[2] == (2, 0.0, 5.0, 1) and got[20] == (20, 90.0, 95.0, 1)
    assert sum(n for *_, n in got) == 3 and got[1] == (1, -5.0, 0.0, 0)
    for lo, hi in ((0.0, 0.3), (1.0, 1e9), (-3e-4, 5e-4)):
        two = spark.createDataFrame([(lo,), (hi,)], "x double")
        bins = st.histogram(two, "x", 30).count()
        assert 12 <= bins <= 31


def test_display_labels(spark):
    shown = al.display_alerts(make_alerts(spark, [("a", 1234.5, "x", "CA")]))
    assert shown.columns == ["ID", "Time", "Amount", "Merchant", "Category", "First Name", "Last Name", "State", "City"]
    assert shown.first()["Amount"] == "$1,234.50"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(hs.integers(-50, 50), hs.integers(0, 9)), min_size=1, max_size=30,
                unique_by=lambda r: r[0]), hs.sampled_from([1, 3, 7, 1000]))
def test_running_totals_against_brute_force(spark, rows, span):
    frame = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: r.cum_v for r in st.with_running_totals(frame, "k", ["v"], span).collect()}
    assert got == {k: sum(v for j, v in rows if j <= k) for k, _ in rows}


def test_running_totals_keep_rows_without_order(spark):
    frame = spark.createDataFrame([(None, 5), (1, 2)], "k int, v int")
    assert {r.k: r.cum_v for r in st.with_running_totals(frame, "k", ["v"]).collect()} == {None: 5, 1: 7}


def test_batch_progress_by_hand(spark):
    scored = spark.createDataFrame(
        [(0, 1, 1.0), (0, 0, 1.0), (1, None, 0.0), (1, 1, 0.0)], "batch_id int, is_fraud int, prediction double"
    )
    got = {r.batch_id: r for r in st.batch_progress(st.batch_metrics(scored)).collect()}
    assert (got[0].n, got[0].fraud, got[0].alerts, got[0].caught) == (2, 1, 2, 1)
    assert (got[1].cum_n, got[1].cum_fraud, got[1].cum_caught, got[1].cum_fraud_pct) == (4, 2, 1, 50.0)


def test_profile_of_nothing(spark):
    none = spark.createDataFrame([], "is_fraud int")
    assert tuple(st.dataset_profile(none).first()) == (0, 0, None, 0)
    assert st.count_by(none.withColumn("k", F.lit(1)), "k").collect() == []


@pytest.mark.parametrize("n", [1, 5, 37, 90, 500])
def test_limits_take_the_newest_rows(spark, n):
    import random

    rnd = random.Random(n)
    rows = [(f"t{i:03d}", rnd.randint(1, 9), "c", "s") for i in range(90)]
    alerts = make_alerts(spark, rows).withColumn(
        "detected_at", F.col("detected_at") - F.expr("make_interval(0,0,0,0,0, pmod(hash(transaction_id), 20), 0)")
    ).withColumn("detected_at", F.expr("if(transaction_id = 't007', null, detected_at)"))
    by_time = sorted(alerts.collect(), key=lambda r: r.transaction_id)
    by_time.sort(key=lambda r: (r.detected_at is not None, r.detected_at and r.detected_at.timestamp(), r.transaction_time), reverse=True)
    assert ids(al.newest(alerts, n)) == [r.transaction_id for r in by_time[:n]]

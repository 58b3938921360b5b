from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs

from riskstream.operators import metrics as mt
from riskstream.operators import sampling as sm

PAIRS = hs.lists(hs.tuples(hs.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), hs.integers(0, 1)),
                 min_size=2, max_size=40)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    return spark.createDataFrame(rows, "score double, is_fraud int")


@QUICK
@given(PAIRS.filter(lambda rows: len({y for _, y in rows}) == 2))
def test_area_against_all_pairs(spark, rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert mt.area_under_roc(_frame(spark, rows), "score") == pytest.approx(wins / len(pos) / len(neg))


@QUICK
@given(PAIRS)
def test_sweep_against_brute_force(spark, rows):
    cuts = [0.1, 0.5, 0.95]
    table = mt.threshold_sweep(_frame(spark, rows), "score", cuts).collect()
    got = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in table}
    assert got == {t: (sum(s >= t and y == 1 for s, y in rows), sum(s >= t and y == 0 for s, y in rows),
                       sum(s < t and y == 1 for s, y in rows), sum(s < t and y == 0 for s, y in rows)) for t in cuts}


def test_published_matrix_rates(spark):
    counts = spark.createDataFrame([(100, 92, 1, 10970)], "tp long, fp long, fn long, tn long")
    row = mt.rates(counts).first()
    assert (row.precision, row.recall, row.f1, row.fpr) == (0.520833, 0.990099, 0.682594, 0.008317)


def test_metrics_of_nothing_are_null(spark):
    none = spark.createDataFrame([], "is_fraud int, prediction double")
    row = mt.classification_metrics(none).first()
    assert (row.tp, row.precision, row.recall, row.f1, row.fpr, row.accuracy) == (0, None, None, None, None, None)


def test_rows_without_label_are_not_counted(spark):
    rows = spark.createDataFrame([(None, 1.0), (1, None), (1, 1.0)], "is_fraud int, prediction double")
    assert tuple(mt.confusion_matrix(rows).first()) == (1, 0, 0, 0)


def test_split_is_complete_disjoint_and_repeatable(spark):
    rows = spark.range(5000).withColumnRenamed("id", "transaction_id")
    train, test = sm.train_test(rows)
    assert train.count() + test.count() == 5000 and train.join(test, "transaction_id").isEmpty()
    assert 0.77 < train.count() / 5000 < 0.83
    again, _ = sm.train_test(rows.repartition(13))
    assert again.exceptAll(train).isEmpty()
    assert {r.split: r.n for r in sm.split_counts(sm.with_split(rows)).collect()} == {
        "train": train.count(), "test": test.count()}


def test_samples_nest_and_honour_the_ends(spark):
    rows = spark.range(3000).withColumnRenamed("id", "transaction_id")
    some, more = sm.hash_sample(rows, 0.3), sm.hash_sample(rows, 0.5)
    assert some.exceptAll(more).isEmpty() and 0.26 < some.count() / 3000 < 0.34
    assert sm.hash_sample(rows, 0.0).isEmpty() and sm.hash_sample(rows, 1.0).count() == 3000
    with pytest.raises(ValueError):
        sm.hash_sample(rows, 1.1)


def test_rows_without_a_score_are_left_out(spark):
    rows = [(0.9, 1), (float("nan"), 1), (None, 0), (0.2, None), (0.1, 0)]
    row = mt.threshold_sweep(_frame(spark, rows), "score", [0.5]).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 0, 0, 1)
    assert mt.area_under_roc(_frame(spark, rows), "score") == 1.0


def test_area_of_one_class_is_unknown(spark):
    frame = spark.createDataFrame([(1, 0.5), (1, 0.7)], "is_fraud int, score double")
    assert mt.area_under_roc(frame, "score") is None and mt.auc_roc(frame, "score").first().auc is None


def test_statistics_of_odd_alerts(spark):
    from riskstream.operators import stats
    rows = [(None, "TX", 10.0), ("null", "TX", float("nan")), ("a", None, float("inf")), ("a", "", None)]
    alerts = spark.createDataFrame(rows, "category string, state string, amount double")
    row = stats.alert_stats_maps(alerts).first()
    assert (row.total_alerts, row.total_amount, row.avg_amount) == (4, 10.0, 10.0) == tuple(stats.alert_stats(alerts).first())
    assert row.by_category == {"null": 2, "a": 2} and row.by_state == {"TX": 2}


def test_area_and_splits_by_brute_force(spark):
    import random
    from riskstream.operators import ordered
    draw = random.Random(2)
    rows = [(draw.choice([0.1, 0.5, draw.random(), draw.random(), None, float("nan")]), float(draw.randrange(9)), draw.choice([0, 0, 1, None])) for _ in range(800)]
    df = spark.createDataFrame(rows, "score double, k double, is_fraud int")
    known = [(s, y) for s, _, y in rows if s is not None and s == s and y is not None]
    good, bad = [s for s, y in known if y == 1], [s for s, y in known if y == 0]
    area = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert abs(ordered.area_under_curve(df.where("not isnan(score)"), "score", "is_fraud").first().auc - area) < 1e-12
    assert ordered.area_under_curve(df.where("is_fraud = 1"), "score", "is_fraud").first().auc is None
    assert ordered.area_under_curve(df.limit(0), "score", "is_fraud").first().auc is None

    def gini(ys):
        p = sum(ys) / len(ys)
        return 2 * p * (1 - p)

    got = {r.feature: r for r in ordered.split_search(df, ["score", "k"], "is_fraud").collect()}
    for at, name in ((0, "score"), (1, "k")):
        pairs = [(r[at], r[2]) for r in rows if r[at] is not None and r[at] == r[at] and r[2] is not None]
        tries = []
        for cut in sorted({v for v, _ in pairs})[:-1]:
            left, right = [y for v, y in pairs if v <= cut], [y for v, y in pairs if v > cut]
            tries.append((round(gini([y for _, y in pairs]) - (len(left) * gini(left) + len(right) * gini(right)) / len(pairs), 9), -cut, len(left), sum(left)))
        gain, cut, n_left, pos_left = max(tries)
        assert abs(got[name].gain - gain) < 2e-9 and got[name].n == len(pairs)
        assert (got[name].threshold, got[name].n_left, got[name].pos_left) == (-cut, n_left, pos_left)
    assert ordered.split_search(df.limit(0), ["k"], "is_fraud").count() == 0

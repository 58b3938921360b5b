from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskstream.functions import scalars
from riskstream.operators import features as ft
from riskstream.operators.lookup import category_risk, with_category_risk
from riskstream.schema import ALL_FEATURES, BOOSTED_FEATURES, NUMERIC_FEATURES, ONE_HOT_COLUMNS


@pytest.mark.parametrize("amount, high, extreme", [
    (100.0, 0, 0), (100.01, 1, 0), (500.0, 1, 0), (500.01, 1, 1), (None, 0, 0), (-2.0, 0, 0),
])
def test_amount_flags(one, amount, high, extreme):
    row = one({"amount": (amount, "double")}, ft.amount_features())
    assert (row.is_high_value, row.is_extreme_value) == (high, extreme)


@pytest.mark.parametrize("amount, log", [(0.0, 0.0), (math.e - 1, 1.0), (-2.0, None), (None, None)])
def test_amount_log(one, amount, log):
    got = one({"amount": (amount, "double")}, ft.amount_features()).amount_log
    assert got == (pytest.approx(log) if log is not None else None)


@pytest.mark.parametrize("dob, as_of, age", [
    ("1980-03-02", "2020-03-01", 39), ("1980-03-02", "2020-03-02", 40),
    ("1980-02-29", "2023-02-28", 43), ("1980-02-29", "2023-02-27", 42),
    ("1980-01-01 12:30:00", "2020-06-01", 40), ("nope", "2020-01-01", None), (None, "2020-01-01", None),
])
def test_age(one, dob, as_of, age):
    row = one({"dob": (dob, "string")}, ft.age_feature(F.lit(dt.date.fromisoformat(as_of))))
    assert row.age == age


@pytest.mark.parametrize("gender, code", [
    ("M", 1), ("male", 1), ("F", 0), ("FEMALE", 0), ("x", -1), ("", -1), (None, -1),
])
def test_gender(one, gender, code):
    assert one({"gender": (gender, "string")}, ft.gender_feature()).gender_encoded == code


@pytest.mark.parametrize("category, expected", [
    ("Grocery_POS", {"cat_grocery_pos"}), ("travel", {"cat_travel"}), ("others", {"cat_others"}),
    ("home", set()), (None, set()),
])
def test_one_hot(one, category, expected):
    row = one({"category": (category, "string")}, ft.category_one_hot()).asDict()
    assert {n for n, v in row.items() if v == 1} == expected and set(row.values()) <= {0, 1}


@pytest.mark.parametrize("amount, population, ratio", [
    (50.0, None, 0.0), (50.0, 0, 0.0), (50.0, -3, 0.0), (50.0, 10, 5.0), (None, 10, None),
])
def test_population_ratio(one, amount, population, ratio):
    row = one({"amount": (amount, "double"), "city_pop": (population, "int")}, ft.population_ratio())
    assert row.amt_to_pop_ratio == ratio


@pytest.mark.parametrize("time, weekend, hour, night", [
    ("2024-01-05T23:59:59", 0, 23, 1), ("2024-01-06T00:00:00", 1, 0, 1), ("2024-01-07T05:59:00", 1, 5, 1),
    ("2024-01-08T06:00:00", 0, 6, 0), ("2024-01-08T22:00:00", 0, 22, 1), (None, 0, None, 0),
])
def test_time_features(one, time, weekend, hour, night):
    moment = dt.datetime.fromisoformat(time) if time else None
    row = one({"transaction_time": (moment, "timestamp")}, ft.temporal_features() | ft.night_feature())
    assert (row.is_weekend, row.hour_of_day, row.is_night) == (weekend, hour, night)


def _distance(one, *points):
    names = ("lat", "long", "merch_lat", "merch_long")
    return one({n: (p, "double") for n, p in zip(names, points)}, ft.distance_feature(list(names)))[0]


def test_distance_known_values(one):
    assert _distance(one, 10.0, 20.0, 10.0, 20.0) == 0.0
    assert _distance(one, 0.0, 0.0, 0.0, 90.0) == pytest.approx(6371 * math.pi / 2)
    # Opposite points: rounding may push the haversine above 1; the result stays defined.
    for lat in (0.0, 12.3, 45.0, 67.8, 89.9):
        assert _distance(one, lat, 0.0, -lat, 180.0) == pytest.approx(6371 * math.pi)


def test_distance_unknown(one, spark):
    assert _distance(one, None, 0.0, 1.0, 1.0) is None
    assert math.isnan(_distance(one, float("nan"), 0.0, 1.0, 1.0))
    without = spark.range(1).select(*[c.alias(n) for n, c in ft.distance_feature(["lat", "long"]).items()])
    assert without.dtypes == [("distance_customer_merchant", "double")] and without.first()[0] is None


def test_full_frame_is_one_projection(spark, small):
    from riskstream.plans.transactions import transactions

    txns = transactions(spark, small)
    frame = ft.with_features(txns)
    added = set(frame.columns) - set(txns.columns)
    assert set(ALL_FEATURES) <= set(frame.columns)
    assert len(added) == 23 and "hour_of_day" in txns.columns  # the 24th replaces the payload's hour
    assert set(BOOSTED_FEATURES) <= set(frame.columns) and len(BOOSTED_FEATURES) == 21
    assert len(NUMERIC_FEATURES) == 10 and len(ONE_HOT_COLUMNS) == 13


def test_file_style_names_are_accepted(spark):
    row = spark.createDataFrame(
        [("2020-01-04 10:00:00", 150.0, "F", "1980-01-01", "travel", 10)],
        "trans_date_trans_time string, amt double, gender string, dob string, category string, city_pop int",
    )
    got = ft.with_features(row, F.lit(dt.date(2020, 1, 4))).first()
    assert (got.amount, got.hour_of_day, got.is_weekend, got.is_high_value, got.age) == (150.0, 10, 1, 1, 40)
    assert got.distance_customer_merchant is None and got.date == dt.date(2020, 1, 4)


def test_category_risk_prior_and_unseen(spark):
    train = spark.createDataFrame(
        [("a", 1), ("a", 0), ("A", 1), ("b", 0), (None, 1)], "category string, is_fraud int"
    )
    risk = category_risk(train, smoothing=2.0)
    rows = spark.createDataFrame([("A", 10.0), ("b", 1.0), ("zzz", 2.0), (None, 1.0)],
                                 "category string, amount double")
    got = {r.category: r for r in with_category_risk(rows, risk).collect()}
    assert got["A"].category_risk_score == pytest.approx((2 + 0.6 * 2) / 5)
    assert got["b"].category_risk_score == pytest.approx((0 + 0.6 * 2) / 3)
    assert got["zzz"].category_risk_score == got[None].category_risk_score == pytest.approx(0.6)
    assert got["A"].risk_amount_interaction == pytest.approx(got["A"].category_risk_score * 10)


def test_category_risk_runs_and_keeps_nothing_while_planned(spark):
    train = spark.createDataFrame([("A", 1), ("a", 0), (None, 0)], "category string, is_fraud int")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = with_category_risk(train.withColumn("amount", F.lit(10.0)), category_risk(train))
    assert rows.count() == 3 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept


@pytest.mark.parametrize("code, padded", [("42", "00042"), ("12345", "12345"), ("123456", "123456"),
                                          ("", "00000"), (None, None)])
def test_zip_pad(one, code, padded):
    assert one({"z": (code, "string")}, {"z": scalars.zip_pad(F.col("z"))}).z == padded


@pytest.mark.parametrize("card, masked", [("4111222233334444", "4444****"), ("12", "12****"),
                                          ("", "N/A"), (None, "N/A")])
def test_mask_card(one, card, masked):
    assert one({"c": (card, "string")}, {"c": scalars.mask_card(F.col("c"))}).c == masked


@pytest.mark.parametrize("amount, text", [(1234.5, "$1,234.50"), (0.0, "$0.00"), (1e6, "$1,000,000.00"),
                                          (None, None)])
def test_format_amount(one, amount, text):
    assert one({"a": (amount, "double")}, {"a": scalars.format_amount(F.col("a"))}).a == text


@pytest.mark.parametrize("micros", [0, 1, 500_000])
def test_iso_timestamp(one, micros):
    moment = dt.datetime(2020, 1, 2, 3, 4, 5, micros)
    assert one({"t": (moment, "timestamp")}, {"t": scalars.iso_timestamp(F.col("t"))}).t == moment.isoformat()

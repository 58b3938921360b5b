"""Feature columns.

Each group is a mapping name -> Column over the input columns only, so any subset can be
computed alone and the full set is one projection, on a batch table and on a stream alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import flag, full_years, great_circle_km, ratio_or_zero
from riskstream.operators.columns import normalize_columns
from riskstream.schema import (
    EXTREME_VALUE, HIGH_VALUE, NIGHT_ENDS, NIGHT_STARTS, ONE_HOT_CATEGORIES,
)

Features = dict[str, Column]


def amount_features() -> Features:
    amount = F.col("amount")
    return {
        "amount_log": F.log1p(amount),
        "is_high_value": flag(amount > HIGH_VALUE),
        "is_extreme_value": flag(amount > EXTREME_VALUE),
    }


def age_feature(as_of: Column | None = None) -> Features:
    """Age at ``as_of``: today by default, a fixed date for repeatable runs, or a column
    such as the transaction day so that training and serving agree."""
    return {"age": full_years(F.col("dob"), F.current_date() if as_of is None else as_of)}


def gender_feature() -> Features:
    spelled = F.lower("gender")
    code = F.when(spelled.isin("m", "male"), 1).when(spelled.isin("f", "female"), 0)
    return {"gender_encoded": code.otherwise(-1)}


def temporal_features() -> Features:
    time = F.col("transaction_time")
    return {
        "hour_of_day": F.hour(time),
        "is_weekend": flag(F.weekday(time) >= 5),
    }


def distance_feature(columns: list[str]) -> Features:
    """Customer-to-merchant distance; null when a coordinate column is missing altogether."""
    points = ("lat", "long", "merch_lat", "merch_long")
    if set(points) <= set(columns):
        distance = great_circle_km(*[F.col(c) for c in points])
    else:
        distance = F.lit(None).cast("double")
    return {"distance_customer_merchant": distance}


def out_of_state_feature() -> Features:
    """Constant: no source carries the merchant's state."""
    return {"is_out_of_state": F.lit(0)}


def category_one_hot() -> Features:
    spelled = F.lower("category")
    return {f"cat_{name}": flag(spelled == name) for name in ONE_HOT_CATEGORIES}


def population_ratio() -> Features:
    return {"amt_to_pop_ratio": ratio_or_zero(F.col("amount"), F.col("city_pop"))}


def date_feature() -> Features:
    return {"date": F.to_date("transaction_time")}


def core_features(columns: list[str], as_of: Column | None = None) -> Features:
    return (
        amount_features() | age_feature(as_of) | gender_feature() | temporal_features()
        | distance_feature(columns) | out_of_state_feature() | category_one_hot()
        | population_ratio() | date_feature()
    )


def with_features(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Input columns plus the 24 derived ones and the ``date`` partition key."""
    df = normalize_columns(df)
    return df.withColumns(core_features(df.columns, as_of))


# --- Features that are only named in the published feature lists; the definitions are ours. ---

def night_feature() -> Features:
    hour = F.hour("transaction_time")
    return {"is_night": flag((hour >= NIGHT_STARTS) | (hour < NIGHT_ENDS))}


def cyclic_features() -> Features:
    time = F.col("transaction_time")
    angle = F.hour(time) * (2 * math.pi / 24)
    return {
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
        "day_of_week": F.dayofweek(time),
        "day_of_month": F.dayofmonth(time),
    }


def interaction_features() -> Features:
    """Needs ``age`` and ``hour_of_day``, so it is applied after the core features."""
    amount, age, population = F.col("amount"), F.col("age"), F.col("city_pop")
    return {
        "amt_per_age": ratio_or_zero(amount, age),
        "amt_per_city_pop": ratio_or_zero(amount, population),
        "lat_long_interaction": F.col("lat") * F.col("long"),
        "merch_lat_long_interaction": F.col("merch_lat") * F.col("merch_long"),
        "hour_amt_interaction": F.col("hour_of_day") * amount,
        "age_city_pop_interaction": age * population,
    }


def amount_bucket() -> Features:
    amount = F.col("amount")
    label = (
        F.when(amount > EXTREME_VALUE, "extreme").when(amount > HIGH_VALUE, "high")
        .when(amount.isNotNull(), "normal")
    )
    return {"amount_category": label}


def extend_features(core: DataFrame) -> DataFrame:
    """Adds night, cyclic, interaction and bucket features to a frame with the core ones."""
    return core.withColumns(
        night_feature() | cyclic_features() | interaction_features() | amount_bucket()
    )


def with_extended_features(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Everything any model recipe reads, but for the category risk."""
    return extend_features(with_features(df, as_of))

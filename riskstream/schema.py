"""Schemas, column lists and thresholds shared by the whole package."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
    "bigint": T.LongType(), "int": T.IntegerType(),
}


def _schema(fields: str) -> T.StructType:
    """``name type`` pairs, one per line; ``!`` after the type means non-null."""
    pairs = [line.split() for line in fields.strip().splitlines()]
    return T.StructType([
        T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in pairs
    ])


# ---------------------------------------------------------------------------
# Field names, types and nullability of the wire format.
# ---------------------------------------------------------------------------
TRANSACTION_SCHEMA = _schema(
    """
    transaction_id string!
    transaction_time timestamp!
    amount double!
    unix_time bigint!
    hour_of_day int!
    cc_num string!
    first string
    last string
    gender string
    dob string
    job string
    street string
    city string
    state string
    zip string
    lat double
    long double
    city_pop int
    merchant string!
    category string!
    merch_lat double
    merch_long double
    is_fraud int
    """
)

# A message without one of these cannot be archived by day or scored.
REQUIRED_FIELDS = ("transaction_id", "transaction_time", "amount")

# Training and replay files. Card numbers and ZIP codes stay text so that neither
# overflow nor a lost leading zero can change them; the time is parsed later.
TRAINING_CSV_SCHEMA = _schema(
    """
    trans_num string
    trans_date_trans_time string
    cc_num string
    merchant string
    category string
    amt double
    first string
    last string
    gender string
    street string
    city string
    state string
    zip string
    lat double
    long double
    city_pop int
    job string
    dob string
    unix_time bigint
    merch_lat double
    merch_long double
    is_fraud int
    """
)
CSV_INDEX_COLUMN = "Unnamed: 0"
UNNAMED_CSV_INDEX_COLUMN = "_c0"  # what Spark calls a first column with an empty header

# Alert row: everything up to `zip` is copied from the transaction.
ALERT_COPIED_COLUMNS = (
    "transaction_id", "transaction_time", "amount", "merchant", "category", "cc_num",
    "first", "last", "gender", "job", "state", "city", "zip",
)
ALERT_COLUMNS = ALERT_COPIED_COLUMNS + ("is_fraud", "detected_at")
ALERT_SERVED_COLUMNS = (
    "transaction_id", "transaction_time", "amount", "merchant", "category", "cc_num",
    "first", "last", "state", "city", "is_fraud", "detected_at",
)
ALERT_LATEST_COLUMNS = ("transaction_id", "amount", "category", "merchant", "detected_at")
ALERT_DISPLAY_LABELS = {
    "transaction_id": "ID",
    "transaction_time": "Time",
    "amount": "Amount",
    "merchant": "Merchant",
    "category": "Category",
    "first": "First Name",
    "last": "Last Name",
    "state": "State",
    "city": "City",
}
ALERT_LIMIT_RANGE = (1, 100_000)
ALERT_RETENTION_DAYS = 30

# ---------------------------------------------------------------------------
# Feature thresholds, one-hot vocabulary and feature lists.
# ---------------------------------------------------------------------------
HIGH_VALUE = 100
EXTREME_VALUE = 500
EARTH_RADIUS_KM = 6371
NIGHT_STARTS, NIGHT_ENDS = 22, 6

ONE_HOT_CATEGORIES = (
    "grocery_pos", "shopping_net", "misc_net", "gas_transport", "shopping_pos",
    "food_dining", "personal_care", "health_fitness", "entertainment", "utilities",
    "travel", "electronics", "others",
)
ONE_HOT_COLUMNS = tuple(f"cat_{name}" for name in ONE_HOT_CATEGORIES)

NUMERIC_FEATURES = (
    "amount", "amount_log", "is_high_value", "is_extreme_value", "age", "gender_encoded",
    "hour_of_day", "is_weekend", "distance_customer_merchant", "amt_to_pop_ratio",
)
CATEGORICAL_FEATURES = ONE_HOT_COLUMNS + ("category",)
ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

BOOSTED_FEATURES = (
    "amount", "age", "city_pop", "hour_of_day", "is_weekend", "amount_log",
    "is_high_value", "is_extreme_value", "distance_customer_merchant", "is_out_of_state",
    "amt_to_pop_ratio", "gender_encoded",
) + ONE_HOT_COLUMNS[:9]

# The published list of the large forest, under the names the features have here.
FOREST_FEATURES = (
    "amount", "age", "city_pop", "hour_of_day", "day_of_week", "day_of_month", "is_weekend",
    "hour_sin", "hour_cos", "amount_log", "lat", "long", "merch_lat", "merch_long",
    "distance_customer_merchant", "amt_per_age", "amt_per_city_pop", "lat_long_interaction",
    "merch_lat_long_interaction", "hour_amt_interaction", "age_city_pop_interaction",
)

LEAN_FEATURES = (
    "amount", "amount_log", "is_high_value", "is_extreme_value", "category_risk_score",
    "risk_amount_interaction", "hour_of_day", "is_night",
)

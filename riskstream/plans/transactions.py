"""The transaction table derived from the star-schema test tables.

Dimension joins carry no broadcast hint: small dimensions are broadcast by their measured
size, large ones are shuffled and adaptive execution splits hot customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.functions.scalars import iso_timestamp
from riskstream.schema import TRAINING_CSV_SCHEMA, TRANSACTION_SCHEMA
from riskstream.session import spread_small

# The category rota and genders of the derived table. `misc_pos`, `kids_pets`
# and `home` are outside the one-hot vocabulary on purpose, the last entry tests case.
CATEGORY_ROTA = (
    "grocery_pos", "shopping_net", "misc_net", "gas_transport", "shopping_pos", "food_dining",
    "personal_care", "health_fitness", "entertainment", "travel", "misc_pos", "kids_pets",
    "home", "Grocery_POS",
)
GENDER_ROTA = ("M", "F", "female")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The 23 transaction columns, one row per event."""
    supplier = table(spark, folder, "supplier")
    n_suppliers = supplier.agg(F.count("*")).scalar()
    key, draw = F.col("c_custkey"), F.get_json_object("props", "$.k").cast("int")
    events = spread_small(table(spark, folder, "events")).select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("time"),
        (F.col("value") * 2).alias("amount"), draw.alias("draw"),
        (F.col("event_id") % n_suppliers).alias("supplier_no"),
    )
    wide = (
        events.join(table(spark, folder, "customer"), F.col("user_id") == key, "left")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(supplier, F.col("supplier_no") == F.col("s_suppkey"), "left")
    )
    amount, event = F.col("amount"), F.col("event_id")
    lat = (key % 25 + 25).cast("double")
    long = (key % 50 - 120).cast("double")
    birth = F.date_add(F.lit("1950-01-01").cast("date"), (key * 97 % 18000).cast("int"))
    state = F.when(key % 31 == 1, "").when(key % 29 != 1, F.col("n_name"))
    risky = ((amount > 400) & (F.col("draw") >= 40)) | ((amount > 200) & (F.col("draw") >= 85))
    fields = {
        "transaction_id": F.concat(F.lit("T"), F.lpad(event.cast("string"), 10, "0")),
        "transaction_time": F.col("time"),
        "amount": amount,
        "unix_time": F.unix_timestamp("time"),
        "hour_of_day": F.hour("time"),
        "cc_num": F.concat(F.lit("4000"), F.lpad(F.col("user_id").cast("string"), 12, "0")),
        "first": F.concat(F.lit("F"), (key % 100).cast("string")),
        "last": F.col("c_name"),
        "gender": F.get(F.array(*[F.lit(g) for g in GENDER_ROTA]), (key % 4).cast("int")),
        "dob": F.when(key % 17 != 1, birth.cast("string")),
        "job": F.col("c_mktsegment"),
        "street": F.concat(key.cast("string"), F.lit(" Main St")),
        "city": F.concat(F.lit("CITY_"), (key % 50).cast("string")),
        "state": state,
        "zip": F.lpad(key.cast("string"), 5, "0"),
        "lat": lat,
        "long": long,
        "city_pop": F.when(key % 13 != 1, (key * 37 % 5000).cast("int")),
        "merchant": F.col("s_name"),
        "category": F.get(F.array(*[F.lit(c) for c in CATEGORY_ROTA]), F.col("draw") % 14),
        "merch_lat": lat + (event % 21 - 10) / 10.0,
        "merch_long": long + (event % 13 - 6) / 10.0,
        "is_fraud": F.when(risky, 1).otherwise(0),
    }
    return wide.select(*[fields[name].alias(name) for name in TRANSACTION_SCHEMA.names])


def replay_file_rows(txns: DataFrame) -> DataFrame:
    """The same rows under the names and order of a training or replay file, time as text."""
    renamed = txns.withColumn("transaction_time", iso_timestamp(F.col("transaction_time"))) \
        .withColumnsRenamed({"transaction_id": "trans_num", "amount": "amt",
                             "transaction_time": "trans_date_trans_time"})
    return renamed.select(*TRAINING_CSV_SCHEMA.names)


def with_rule_prediction(txns: DataFrame) -> DataFrame:
    """The high-value flag as a prediction, for queries that need one without a model."""
    return txns.withColumn("prediction", F.when(F.col("amount") > 100, 1.0).otherwise(0.0))

"""Column-level clean-up: source aliases, stray index columns, labels, record shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import iso_timestamp, zip_pad
from riskstream.schema import (
    CSV_INDEX_COLUMN, TRANSACTION_SCHEMA, UNNAMED_CSV_INDEX_COLUMN,
)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Map file-style names onto stream-style ones unless the target already exists.

    The time is added next to its source; amount and id are renamed.
    """
    have = set(df.columns)
    if "trans_date_trans_time" in have and "transaction_time" not in have:
        parsed = F.col("trans_date_trans_time").try_cast("timestamp")
        df = df.withColumn("transaction_time", parsed)
    renames = {"amt": "amount", "trans_num": "transaction_id"}
    return df.withColumnsRenamed(
        {old: new for old, new in renames.items() if old in have and new not in have}
    )


def drop_index_column(df: DataFrame) -> DataFrame:
    """Remove the row-number column that data-frame exports leave behind, under either name."""
    return df.drop(CSV_INDEX_COLUMN, UNNAMED_CSV_INDEX_COLUMN)


def with_label(df: DataFrame, source: str = "is_fraud", target: str = "label") -> DataFrame:
    """Integer label; text that is no number becomes null instead of failing the job."""
    return df.withColumn(target, F.col(source).try_cast("int"))


def _record_fields() -> dict[str, Column]:
    time = F.col("trans_date_trans_time").try_cast("timestamp")
    text = ("cc_num", "first", "last", "gender", "dob", "job", "street", "city", "state",
            "merchant", "category")
    fields = {
        "transaction_id": F.col("trans_num").cast("string"),
        "transaction_time": iso_timestamp(time),
        "amount": F.col("amt").try_cast("double"),
        "unix_time": F.col("unix_time").try_cast("bigint"),
        "hour_of_day": F.hour(time),
        "zip": zip_pad(F.col("zip").cast("string")),
        "city_pop": F.col("city_pop").try_cast("int"),
        "is_fraud": F.col("is_fraud").try_cast("int"),
    }
    fields |= {name: F.col(name).cast("string") for name in text}
    fields |= {name: F.col(name).try_cast("double")
               for name in ("lat", "long", "merch_lat", "merch_long")}
    return fields


def shape_record(replay: DataFrame) -> DataFrame:
    """Replay-file row to wire record: 23 typed fields in wire order, time as ISO text."""
    fields = _record_fields()
    return replay.select(*[fields[name].alias(name) for name in TRANSACTION_SCHEMA.names])


def to_messages(records: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keyed JSON messages, the shape both the Kafka sink and the file sink take."""
    return records.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def replay_order(df: DataFrame, key: str = "transaction_id", seed: int = 42) -> DataFrame:
    """The whole table in a seeded pseudo-random order (a range-partitioned sort on a hash).

    The row number within the input breaks ties, so the copies of a much re-sent key can be
    cut into several ranges.
    """
    order = [F.xxhash64(F.lit(seed), F.col(key)), F.col(key), F.monotonically_increasing_id()]
    return df.orderBy(*order)

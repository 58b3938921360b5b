"""Row quality: bad-record quarantine and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.schema import REQUIRED_FIELDS


def is_bad() -> Column:
    """True for a row that lacks a required field, as every unreadable message does."""
    return reduce(Column.__or__, [F.col(name).isNull() for name in REQUIRED_FIELDS])


def with_missing(parsed: DataFrame) -> DataFrame:
    """Adds ``missing``: the absent required fields, empty for a good row."""
    names = [F.when(F.col(n).isNull(), n) for n in REQUIRED_FIELDS]
    return parsed.withColumn("missing", F.concat_ws(",", *names))


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) for two sinks; neither side shuffles."""
    return parsed.filter(~is_bad()), with_missing(parsed.filter(is_bad()))


def latest_by_key(df: DataFrame, key: str, newest_first: list[Column]) -> DataFrame:
    """One row per key, the first under ``newest_first``.

    Spark turns the ``= 1`` filter on the rank into a group limit before the shuffle, so each
    task sends at most one row per key and a key holding much of the data stays harmless.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*newest_first)))
    return ranked.filter("_rank = 1").drop("_rank")


def drop_resent(stream: DataFrame, key: str = "transaction_id", time: str = "transaction_time",
                lateness: str = "10 minutes") -> DataFrame:
    """Streaming removal of re-sent keys, with state bounded by the watermark.

    All copies of a key in one micro-batch meet in one task, so the trigger's rate limit bounds
    what a much re-sent key can put there; for a whole table use ``latest_by_key``.
    """
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])

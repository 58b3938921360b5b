"""Repeatable samples and splits.

Both depend on a hash of the key and the seed only: not on partitioning, file order or a
retried task, unlike ``sample`` and ``randomSplit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import hash_below


def hash_sample(df: DataFrame, fraction: float, key: str = "transaction_id", seed: int = 42) -> DataFrame:
    return df.filter(hash_below(F.col(key), seed, fraction))


def with_split(df: DataFrame, train_fraction: float = 0.8, key: str = "transaction_id",
               seed: int = 42) -> DataFrame:
    """Adds ``split`` = train or test."""
    train = hash_below(F.col(key), seed, train_fraction)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def train_test(df: DataFrame, train_fraction: float = 0.8, key: str = "transaction_id",
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    tagged = with_split(df, train_fraction, key, seed)
    return tagged.filter("split = 'train'").drop("split"), tagged.filter("split = 'test'").drop("split")


def split_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("split").agg(F.count("*").alias("n"))

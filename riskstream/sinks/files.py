"""File and broker sinks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.config import Settings
from riskstream.session import folders_in, move_folder, remove_folder
from riskstream.sources.tables import read_training_csv


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> None:
    """Columnar copy of a training file, next to the original."""
    read_training_csv(spark, csv_path).write.mode("overwrite").parquet(parquet_path)


def write_archive(df: DataFrame, path: str, mode: str = "append", time_ordered: bool = False) -> None:
    """Day-partitioned Parquet.

    Rows are first gathered by day, with days of very different size split or merged into
    files of like size (an adaptive rebalance). Input already in time order needs no shuffle:
    there a task meets few days anyway.
    """
    gathered = df if time_ordered else df.hint("rebalance", "date")
    gathered.write.mode(mode).partitionBy("date").parquet(path)


def write_archive_batch(df: DataFrame, path: str, batch: str) -> None:
    """One micro-batch into ``path/date=<day>/batch=<batch>``, replacing what an earlier attempt left there.

    Rows are gathered by day first, so a batch adds a file or so to each day it touches, whatever the
    number of its tasks.
    """
    gathered = df.withColumn("batch", F.lit(batch)).hint("rebalance", "date")
    (gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "batch").parquet(path))


def compact_archive_day(spark: SparkSession, path: str, day: dt.date) -> int:
    """Merge the batch folders of a finished day of ``write_archive_batch``; returns how many there were.

    The merged copy is complete, under a name that readers skip, before it takes the place of the day.
    """
    folder = f"{path}/date={day}"
    batches = [name for name, _ in folders_in(spark, folder) if name.startswith("batch=")]
    if len(batches) < 2:
        return len(batches)
    merged = f"{path}/_merging-{uuid.uuid4().hex}"
    rows = spark.read.option("basePath", folder).parquet(folder).drop("batch")
    rows.hint("rebalance").write.parquet(f"{merged}/batch=merged-{uuid.uuid4().hex}")
    remove_folder(spark, folder)
    move_folder(spark, merged, folder)
    return len(batches)


def publish_to_files(messages: DataFrame, path: str) -> None:
    """JSON lines, one message per line; the key is inside the record as well."""
    messages.select("value").write.mode("errorifexists").text(path)


def publish_to_kafka(messages: DataFrame, settings: Settings) -> None:
    """Keyed publish; needs the Kafka connector on the session's class path."""
    messages.write.format("kafka").options(**settings.kafka_sink_options()).save()

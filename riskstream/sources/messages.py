"""Message streams and their parsing.

A message frame has ``value`` (JSON text or bytes) and ``timestamp`` (arrival time). Kafka
delivers that shape; a folder of JSON lines is read into the same one, so everything after
the source is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.config import Settings
from riskstream.schema import TRANSACTION_SCHEMA


def kafka_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """Needs the Kafka connector on the session's class path."""
    return spark.readStream.format("kafka").options(**settings.kafka_source_options()).load()


def _text_messages(reader, path: str) -> DataFrame:
    lines = reader.format("text").load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """One message per line. New files are picked up as they appear."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    return _text_messages(reader, path)


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same folder as a bounded table."""
    return _text_messages(spark.read, path)


def parse_messages(messages: DataFrame, schema: T.StructType | str = TRANSACTION_SCHEMA,
                   keep_raw: bool = False) -> DataFrame:
    """JSON to columns plus the arrival time as ``kafka_timestamp``.

    Unreadable messages become all-null rows and wrongly typed fields become null; nothing is
    dropped here. ``keep_raw`` carries the message text along so bad ones can be stored.

    The struct is inlined rather than selected from: a later filter on its fields would
    otherwise be moved below the parse and parse each message again per field it tests. To
    read few fields, pass a schema with only those.
    """
    text = F.col("value").cast("string")
    carried = [F.col("timestamp").alias("kafka_timestamp")]
    if keep_raw:
        carried.append(text.alias("raw_value"))
    return messages.select(F.inline(F.array(F.from_json(text, schema))), *carried)

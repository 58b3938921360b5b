"""Session construction and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskstream.config import Settings


def build_session(app_name: str = "riskstream", settings: Settings | None = None,
                  master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = (settings or Settings.from_env()).spark_options() | (extra or {})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is a configuration error, since a machine-local path would be lost
    with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = spark.conf.get("spark.riskstream.localFolder", None)
    if not own:
        own = tempfile.mkdtemp(prefix="riskstream-")
        spark.conf.set("spark.riskstream.localFolder", own)
        spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/riskstream/{label}-{uuid.uuid4().hex}"


def spread_small(scan: DataFrame) -> DataFrame:
    """Give every core a piece of a scan that has fewer pieces than there are cores.

    For a plain scan only: its piece count is known without running anything. A table of many
    files passes unchanged, so at scale no shuffle is added.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def folder_exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _located(spark, path)
    return file_system.exists(location)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    file_system, location = _located(spark, source)
    if not file_system.rename(location, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of the folders right under ``path``, in order; none if it does not exist."""
    file_system, location = _located(spark, path)
    if not file_system.exists(location):
        return []
    found = [s for s in file_system.listStatus(location) if s.isDirectory()]
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in found)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder this package wrote, on whatever file system it lies."""
    file_system, location = _located(spark, path)
    return bool(file_system.delete(location, True))


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location

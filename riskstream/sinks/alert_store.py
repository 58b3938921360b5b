"""Keyed alert table on Parquet: a log of micro-batches and a table of one row per transaction.

Every micro-batch owns one folder of the log, ``log/part=r<run>-b<batch>/day=<day of detection>``, which a
replay overwrites as a whole; rows carry ``run_id`` and ``batch_id``. Of a transaction's versions the one of
the newest run counts, then of the newest batch, then with the newest arrival time. The clock
(``detected_at``) comes last, so replaying an old batch later does not let its rows win.

``compact`` merges the log into ``current/day=<day>``, one row per transaction, by rewriting the days that
change. A row lies under the last day on which any version of it was detected, so a winner that has
expired stays, unseen, as long as a version that it replaced has not, and days expire by their names.
Readers rank the versions of transactions in the log only; the rest of the table is a plain scan, which
filters and days reach.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.operators.quality import latest_by_key
from riskstream.schema import ALERT_COLUMNS, ALERT_RETENTION_DAYS, TRANSACTION_SCHEMA
from riskstream.session import folder_exists, folders_in, remove_folder

_TYPES = {f.name: f.dataType for f in TRANSACTION_SCHEMA} | {
    "is_fraud": T.DoubleType(),
    "detected_at": T.TimestampType(),
    "fraud_probability": T.DoubleType(),
    "kafka_timestamp": T.TimestampType(),
    "run_id": T.LongType(),
    "batch_id": T.LongType(),
}
_ROW = ALERT_COLUMNS + ("fraud_probability",)
_ORDER = ("run_id", "batch_id", "kafka_timestamp")
STORE_SCHEMA = T.StructType([T.StructField(c, _TYPES[c]) for c in _ROW + _ORDER])
_CURRENT_SCHEMA = T.StructType([*STORE_SCHEMA, T.StructField("day", T.DateType())])
_LOG_SCHEMA = T.StructType([*_CURRENT_SCHEMA, T.StructField("part", T.StringType())])


def new_run_id() -> int:
    """Grows with every start, so a run begun without its old checkpoint sorts after it."""
    return time.time_ns() // 1_000_000


def run_id_of(spark: SparkSession, checkpoint: str) -> int:
    """The run id of a stream, kept inside its checkpoint: a restart from the checkpoint has the
    same one, so a replayed batch replaces what its failed attempt wrote."""
    path = f"{checkpoint}/run"
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).select(F.lit(new_run_id()).alias("run_id")).write.mode("overwrite").parquet(path)
    return spark.read.schema("run_id long").parquet(path).first().run_id


@dataclass
class AlertStore:
    spark: SparkSession
    root: str
    run_id: int = field(default_factory=new_run_id)

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    @property
    def current_path(self) -> str:
        return f"{self.root}/current"

    def write_batch(self, alerts: DataFrame, batch_id: int) -> None:
        """Replace this run's batch. Columns the alerts lack are stored as null."""
        have = set(alerts.columns)
        added = {"run_id": F.lit(self.run_id), "batch_id": F.lit(batch_id)}
        row = alerts.withColumns(added).select(*[
            (F.col(f.name) if f.name in have or f.name in added else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in STORE_SCHEMA
        ])
        dated = row.withColumn("day", F.to_date("detected_at"))
        dated.write.mode("overwrite").partitionBy("day").parquet(self._batch_folder(batch_id))

    def drop_batch(self, batch_id: int) -> None:
        """Remove this run's batch, for one that turned out to hold no alert."""
        remove_folder(self.spark, self._batch_folder(batch_id))

    def _batch_folder(self, batch_id: int) -> str:
        return f"{self.log_path}/part=r{self.run_id}-b{batch_id}"

    def _log(self) -> DataFrame | None:
        """The versions in the log with ``part`` and ``day``, None without any."""
        parts = [name for name, _ in folders_in(self.spark, self.log_path) if name.startswith("part=")]
        if not parts:
            return None
        return self.spark.read.schema(_LOG_SCHEMA).parquet(self.log_path)

    def _merged(self) -> DataFrame | None:
        """The table of merged rows with ``day``, None before the first merge."""
        days = [name for name, _ in folders_in(self.spark, self.current_path) if name.startswith("day=")]
        return self.spark.read.schema(_CURRENT_SCHEMA).parquet(self.current_path) if days else None

    def versions(self) -> DataFrame:
        """Every stored row, replaced ones of the log included, with the log folder it lies in as ``part``
        (``current`` for merged ones)."""
        columns = [*STORE_SCHEMA.names, "part"]
        log, merged = self._log(), self._merged()
        found = [] if log is None else [log.select(*columns)]
        if merged is not None:
            found.append(merged.withColumn("part", F.lit("current")).select(*columns))
        if not found:
            return self.spark.createDataFrame([], STORE_SCHEMA).withColumn("part", F.lit(None).cast("string"))
        return found[0] if len(found) == 1 else found[0].union(found[1])

    def read(self, as_of: Column | None = None, retention_days: int = ALERT_RETENTION_DAYS) -> DataFrame:
        """Current alerts: one per transaction, not older than the retention period.

        Retention looks at the winning row only, so a replaced row cannot reappear because
        its replacement has expired.
        """
        cutoff = (F.current_timestamp() if as_of is None else as_of) - F.make_dt_interval(F.lit(retention_days))
        log, merged = self._log(), self._merged()
        if log is None and merged is None:
            return self.versions().select(*_ROW)
        seen = []
        if merged is not None:
            seen.append(merged.filter(F.col("day") >= F.to_date(cutoff)).drop("day"))
        if log is not None:
            versions = log.drop("part", "day")
            if merged is not None:
                touched = versions.select("transaction_id").distinct()
                seen[0] = seen[0].join(touched, "transaction_id", "left_anti")
                versions = versions.union(merged.drop("day").join(touched, "transaction_id", "left_semi")
                                          .select(*STORE_SCHEMA.names))
            seen.append(_current(versions))
        rows = [df.filter(F.col("detected_at") >= cutoff).select(*_ROW) for df in seen]
        return rows[0] if len(rows) == 1 else rows[0].union(rows[1])

    def compact(self, keep_newest: bool = False, grace: dt.timedelta = dt.timedelta(0)) -> int:
        """Merge the log into the table of current rows; returns how many log folders went.

        Only the days that hold a touched row, before or after, are rewritten, from a copy that is
        complete before anything goes. ``keep_newest`` leaves the last batch of each run alone, which a
        restarted stream may still replay. Log folders younger than ``grace`` are merged but not deleted,
        for readers that have listed them; merged again they change nothing.
        """
        parts = dict(folders_in(self.spark, self.log_path))
        batches = {name: _run_and_batch(name) for name in parts if name.startswith("part=")}
        if keep_newest:
            newest = dict(sorted(batches.values()))
            batches = {name: (run, batch) for name, (run, batch) in batches.items() if newest[run] != batch}
        if not batches:
            return 0
        log = self._log().filter(F.col("part").isin([name.removeprefix("part=") for name in batches]))
        merged = self._merged()
        touched = log.select("transaction_id").distinct()
        versions, rest, before = log.drop("part"), None, None
        if merged is not None:
            affected = merged.join(touched, "transaction_id", "left_semi").select(*versions.columns)
            before = affected.select("day").distinct()
            versions = versions.union(affected)
            rest = merged.join(touched, "transaction_id", "left_anti").select(*versions.columns)
        staged = f"{self.root}/merging-{uuid.uuid4().hex}"
        try:
            _winners(versions).write.parquet(f"{staged}/rows")
            rows = self.spark.read.parquet(f"{staged}/rows")
            days = rows.select("day").distinct() if before is None else rows.select("day").union(before).distinct()
            days.write.parquet(f"{staged}/days")
            days = self.spark.read.schema("day date").parquet(f"{staged}/days")
            if rest is not None:
                rows = rows.union(rest.join(F.broadcast(days), "day", "left_semi").select(*rows.columns))
            rows.write.parquet(f"{staged}/all")
            self._replace_days(self.spark.read.parquet(f"{staged}/all"), [r.day for r in days.collect()])
        finally:
            remove_folder(self.spark, staged)
        limit = (time.time() - grace.total_seconds()) * 1000
        return self._delete_folders([f"{self.log_path}/{name}" for name in batches if grace <= dt.timedelta(0) or parts[name] < limit])

    def _replace_days(self, rows: DataFrame, days: list[dt.date]) -> None:
        """``days``, one per day of retention or so, become what ``rows`` has of them."""
        (rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(self.current_path))
        left = {r.day for r in rows.select("day").distinct().collect()}
        self._delete_folders([f"{self.current_path}/day={day}" for day in days if day not in left])

    def purge(self, as_of: dt.datetime, retention_days: int = ALERT_RETENTION_DAYS) -> int:
        """Delete the expired days of the merged table by their names, without reading a row; returns how
        many. The log is left to ``compact``: a version in it may be hidden by an expired one."""
        cutoff = (as_of - dt.timedelta(days=retention_days)).date()
        days = [name for name, _ in folders_in(self.spark, self.current_path) if name.startswith("day=")]
        return self._delete_folders([f"{self.current_path}/{name}" for name in days if dt.date.fromisoformat(name[4:]) < cutoff])

    def _delete_folders(self, folders: Iterable[str]) -> int:
        return sum(remove_folder(self.spark, folder) for folder in folders)


def _run_and_batch(part: str) -> tuple[int, int]:
    """``part=r<run>-b<batch>`` as numbers."""
    run, batch = part.removeprefix("part=r").split("-b")
    return int(run), int(batch)


def _winners(versions: DataFrame) -> DataFrame:
    """One row per transaction, the newest version, with the last day of any of them. Pre-aggregated, so
    that a transaction with many versions is one row per task."""
    ahead = [*_ORDER, "detected_at", "amount"]
    row = F.struct(*ahead, *[c for c in STORE_SCHEMA.names if c not in (*ahead, "transaction_id")])
    best = versions.groupBy("transaction_id").agg(F.max(row).alias("best"), F.max("day").alias("day"))
    return best.select(*[F.col(c) if c == "transaction_id" else F.col(f"best.{c}").alias(c) for c in STORE_SCHEMA.names], "day")


def _current(versions: DataFrame) -> DataFrame:
    order = [F.desc_nulls_last(c) for c in _ORDER] + [F.desc("detected_at"), F.desc("amount")]
    return latest_by_key(versions, "transaction_id", order)

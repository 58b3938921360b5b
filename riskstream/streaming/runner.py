"""The streaming job: messages parsed and enriched, feeding archive, quarantine and alerts.

``start_all`` runs a query per sink, each with its own trigger. ``start_joint`` runs one query that reads
and parses each micro-batch once and writes it to all sinks, each write replacing what an earlier attempt
at the same batch has left.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.config import Settings
from riskstream.operators.alerts import alert_projection
from riskstream.operators.features import with_features
from riskstream.operators.quality import drop_resent, is_bad, split_bad, with_missing
from riskstream.operators.stats import batch_counts
from riskstream.schema import ALERT_COPIED_COLUMNS
from riskstream.session import folder_exists, folders_in, remove_folder
from riskstream.sinks.alert_store import AlertStore, run_id_of
from riskstream.sinks.files import write_archive_batch
from riskstream.sources.messages import parse_messages

log = logging.getLogger(__name__)

Scorer = Callable[[DataFrame], DataFrame]
AVAILABLE_NOW = "availableNow"
PROGRESS_SCHEMA = ("run_id long, batch_id long, n long, fraud long, alerts long, caught long, bad long, "
                   "seconds double, rows_per_second double, written_at timestamp")


def enriched(messages: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Message stream to transactions with features. Bad rows stay in, as null rows."""
    return with_features(parse_messages(messages), as_of)


def _started(writer, trigger: str) -> StreamingQuery:
    timed = writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(
        processingTime=trigger
    )
    return timed.start()


def start_archive(transactions: DataFrame, path: str, checkpoint: str,
                  trigger: str = "10 seconds") -> StreamingQuery:
    """Every readable transaction to day-partitioned Parquet, exactly once."""
    writer = (
        transactions.filter(~is_bad()).writeStream.format("parquet").queryName("archive")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("date").outputMode("append")
    )
    return _started(writer, trigger)


def start_quarantine(messages: DataFrame, path: str, checkpoint: str,
                     trigger: str = "10 seconds") -> StreamingQuery:
    """Unusable messages with their text, so they can be repaired and sent again."""
    _, bad = split_bad(parse_messages(messages, keep_raw=True))
    writer = (
        bad.select("raw_value", "kafka_timestamp", "missing").writeStream.format("parquet")
        .queryName("quarantine").option("path", path).option("checkpointLocation", checkpoint)
    )
    return _started(writer, trigger)


def _observed(seen: Observation, rows: DataFrame, aggregates: dict[str, Column]) -> dict[str, int]:
    """What ``seen`` has counted while ``rows`` were written. Where no row was left to write, the plan ends
    early and its counts are lost; then, and only then, the rows are counted on their own."""
    try:
        return seen.get
    except Py4JJavaError:
        return rows.agg(*[c.alias(name) for name, c in aggregates.items()]).first().asDict()


@dataclass
class AlertBatch:
    """What happens to one micro-batch: score, count, keep the positives.

    Rows are counted while the alerts are written, so the source is read and scored once and nothing is
    kept. Only the alerts move, rebalanced into files of an even size after all tasks have filtered; a batch
    without any leaves no folder. A failure stops the query, which retries the batch after a restart;
    with ``dead_letter_path`` set, the batch is stored there instead and the stream goes on.
    """

    score: Scorer
    store: AlertStore
    progress_path: str | None = None
    dead_letter_path: str | None = None
    detected_at: Column | None = None
    run: str = field(default_factory=lambda: uuid.uuid4().hex)  # keeps the dead letters of runs apart

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        try:
            self.process(batch, batch_id)
        except Exception:
            if self.dead_letter_path is None:
                raise
            log.exception("batch %s failed and goes to the dead-letter folder", batch_id)
            batch.write.mode("overwrite").parquet(f"{self.dead_letter_path}/run={self.run}/batch_id={batch_id}")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        started, read, bad = time.monotonic(), Observation(), {"bad": F.count_if(is_bad())}
        seen = batch.observe(read, bad["bad"].alias("bad"))
        counts = self.alert(seen.filter(~is_bad()), batch_id, batch.filter(~is_bad()))
        if counts["n"]:
            self.record(batch.sparkSession, batch_id, counts | _observed(read, batch, bad), time.monotonic() - started)

    def alert(self, good: DataFrame, batch_id: int, unobserved: DataFrame | None = None) -> dict[str, int]:
        """Score the good rows, store the alerts; the counts of the batch. ``unobserved`` are the same rows where
        ``good`` is being observed, which works once only."""
        scored, counted = self.score(good), Observation()
        extra = tuple(c for c in ("fraud_probability", "kafka_timestamp") if c in scored.columns)
        rows = scored.select(*ALERT_COPIED_COLUMNS, "is_fraud", "prediction", *extra)
        seen = rows.observe(counted, *[c.alias(name) for name, c in batch_counts().items()])
        self.store.write_batch(alert_projection(seen, self.detected_at, extra).hint("rebalance"), batch_id)
        counts = _observed(counted, rows if unobserved is None else self.score(unobserved), batch_counts())
        log.info("batch %s: %s", batch_id, counts)
        if not counts["alerts"]:
            self.store.drop_batch(batch_id)
        return counts

    def record(self, spark: SparkSession, batch_id: int, counts: dict[str, int], seconds: float) -> None:
        if self.progress_path:
            values = [counts[c] for c in ("n", "fraud", "alerts", "caught", "bad")]
            row = (self.store.run_id, batch_id, *values, seconds, (counts["n"] + counts["bad"]) / max(seconds, 1e-9))
            names = ", ".join(PROGRESS_SCHEMA.split(", ")[:-1])
            done = spark.createDataFrame([row], names).withColumn("written_at", F.current_timestamp()).coalesce(1)
            done.write.mode("overwrite").parquet(f"{self.progress_path}/part=r{self.store.run_id}-b{batch_id}")


def read_progress(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per run and batch, the last one written."""
    columns = [c.split(" ")[0] for c in PROGRESS_SCHEMA.split(", ")]
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(*paths)
    last = F.max(F.struct("written_at", *[c for c in columns[2:-1]])).alias("last")
    return rows.groupBy("run_id", "batch_id").agg(last).select("run_id", "batch_id", *[f"last.{c}" for c in columns[2:]])


def compact_progress(spark: SparkSession, path: str) -> None:
    """Merge the progress rows of finished batches into one folder. The last batch of each run, which may
    come again, stays apart; a row in both places counts once on reading."""
    parts = [name for name, _ in folders_in(spark, path) if name.startswith("part=")]
    numbered = {n: tuple(map(int, n.removeprefix("part=r").split("-b"))) for n in parts if n.startswith("part=r")}
    newest = dict(sorted(numbered.values()))
    old = [n for n in parts if n not in numbered or newest[numbered[n][0]] != numbered[n][1]]
    if len(old) > 1:
        merged = read_progress(spark, *[f"{path}/{n}" for n in old])
        merged.coalesce(1).write.parquet(f"{path}/part=merged-{uuid.uuid4().hex}")
        for name in old:
            remove_folder(spark, f"{path}/{name}")


def sorted_out(messages: DataFrame) -> DataFrame:
    """Each message once: ``good`` has the fields of a readable transaction, ``raw_value`` and ``missing`` are
    those of an unusable message. What a message does not have is null as a whole, so that a kept piece is
    about as large as its text, also where millions of short messages are no transactions."""
    parsed = with_missing(parse_messages(messages, keep_raw=True))
    fields = F.struct(*[c for c in parsed.columns if c not in ("kafka_timestamp", "raw_value", "missing")])
    return parsed.select(
        "kafka_timestamp", F.when(~is_bad(), fields).alias("good"),
        *[F.when(is_bad(), F.col(c)).alias(c) for c in ("raw_value", "missing")],
    )


@dataclass
class JointBatch:
    """One micro-batch of messages to all sinks, parsed once and kept while they are written.

    Each sink's write replaces what an earlier attempt at the batch left there: archive folders by day
    and batch, a quarantine folder, an alert folder and a progress row per batch.
    """

    alerts: AlertBatch
    archive_path: str
    bad_records_path: str
    as_of: Column | None = None
    scoring: bool = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        started, read = time.monotonic(), Observation()
        part = f"r{self.alerts.store.run_id}-b{batch_id}"
        kept = sorted_out(batch).persist()
        try:
            counted = {"n": F.count("good"), "bad": F.count("missing")}
            seen = kept.observe(read, *[c.alias(name) for name, c in counted.items()])
            write_archive_batch(self._good(seen), self.archive_path, part)
            counts = _observed(read, kept, counted)
            if counts["bad"]:
                bad = kept.filter("missing is not null").select("raw_value", "kafka_timestamp", "missing")
                bad.write.mode("overwrite").parquet(f"{self.bad_records_path}/part={part}")
            if counts["n"] and self.scoring:
                counts |= self._alerted(kept, batch, batch_id)
            if counts["n"] or counts["bad"]:
                self.alerts.record(batch.sparkSession, batch_id, {"fraud": 0, "alerts": 0, "caught": 0} | counts,
                                   time.monotonic() - started)
        finally:
            kept.unpersist()

    def _good(self, kept: DataFrame) -> DataFrame:
        """The readable transactions with their features."""
        return with_features(kept.filter("good is not null").select("good.*", "kafka_timestamp"), self.as_of)

    def _alerted(self, kept: DataFrame, batch: DataFrame, batch_id: int) -> dict[str, int]:
        """A failing scorer spares the other sinks where dead letters are kept."""
        try:
            return self.alerts.alert(self._good(kept), batch_id)
        except Exception:
            if self.alerts.dead_letter_path is None:
                raise
            log.exception("batch %s cannot be scored and goes to the dead-letter folder", batch_id)
            rows = with_features(parse_messages(batch, keep_raw=True), self.as_of)
            rows.write.mode("overwrite").parquet(f"{self.alerts.dead_letter_path}/run={self.alerts.run}/batch_id={batch_id}")
            return {}


def start_alerts(transactions: DataFrame, on_batch: AlertBatch, checkpoint: str,
                 trigger: str = "2 seconds") -> StreamingQuery:
    writer = (
        transactions.writeStream.queryName("alerts").foreachBatch(on_batch)
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    return _started(writer, trigger)


def load_model(path: str) -> PipelineModel | None:
    """The fitted pipeline, or None (archive-only mode) where nothing lies at ``path``. A model that is there and
    cannot be read is an error."""
    if not folder_exists(SparkSession.active(), path):
        log.warning("no model at %s: archive-only mode", path)
        return None
    return PipelineModel.load(path)


def start_all(spark: SparkSession, messages: DataFrame, settings: Settings,
              score: Scorer | None, as_of: Column | None = None) -> list[StreamingQuery]:
    """Start archive, quarantine and, when there is a scorer, alerts."""
    # Queries that ended earlier in this session must not end the wait for these.
    spark.streams.resetTerminated()
    transactions = enriched(messages, as_of)
    if settings.drop_resent_within:
        transactions = drop_resent(transactions.filter(~is_bad()), lateness=settings.drop_resent_within)
    running = [
        start_archive(transactions, settings.archive_path, settings.checkpoint("archive"),
                      settings.archive_trigger),
        start_quarantine(messages, settings.bad_records_path, settings.checkpoint("quarantine"),
                         settings.archive_trigger),
    ]
    if score is None:
        log.warning("no model: alerts are off")
    else:
        checkpoint = settings.checkpoint("alerts")
        store = AlertStore(spark, settings.alerts_path, run_id_of(spark, checkpoint))
        on_batch = AlertBatch(score, store, settings.progress_path, settings.dead_letter_path)
        running.append(start_alerts(transactions, on_batch, checkpoint, settings.alert_trigger))
    return running


def start_joint(spark: SparkSession, messages: DataFrame, settings: Settings,
                score: Scorer | None, as_of: Column | None = None) -> list[StreamingQuery]:
    """All sinks from one query, on the alert trigger. Messages sent again are told by their text."""
    spark.streams.resetTerminated()
    if folder_exists(spark, f"{settings.archive_path}/_spark_metadata"):
        raise ValueError(f"{settings.archive_path} belongs to a file stream, whose readers would not see other files")
    checkpoint = settings.checkpoint("joint")
    store = AlertStore(spark, settings.alerts_path, run_id_of(spark, checkpoint))
    alerts = AlertBatch(score, store, settings.progress_path, settings.dead_letter_path)
    if score is None:
        log.warning("no model: alerts are off")
    if settings.drop_resent_within:
        messages = drop_resent(messages, "value", "timestamp", settings.drop_resent_within)
    on_batch = JointBatch(alerts, settings.archive_path, settings.bad_records_path, as_of, score is not None)
    writer = messages.writeStream.queryName("joint").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return [_started(writer, settings.alert_trigger)]


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for any query to end, so that one failing alone does not go unseen, then stop the rest."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def finish(queries: list[StreamingQuery]) -> None:
    """For bounded runs: wait for each query and raise what it raised."""
    for query in queries:
        query.awaitTermination()

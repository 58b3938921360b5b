from __future__ import annotations

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from riskstream.config import Settings
from riskstream.operators.columns import shape_record, to_messages
from riskstream.operators.features import with_features
from riskstream.operators.quality import drop_resent
from riskstream.operators.stats import batch_progress
from riskstream.plans.transactions import replay_file_rows, transactions, with_rule_prediction
from riskstream.sinks.alert_store import AlertStore
from riskstream.sinks.files import compact_archive_day, write_archive_batch
from riskstream.sources import messages as ms
from riskstream.sources.tables import read_archive
from riskstream.streaming import runner

DATE = dt.date(2024, 6, 30)


@pytest.fixture
def folder(spark, small, tmp_path):
    """The small table as four files of messages, then a garbage line and a re-sent record."""
    path = tmp_path / "in"
    records = shape_record(replay_file_rows(transactions(spark, small)))
    to_messages(records).repartition(4).select("value").write.text(str(path))
    repeated = records.filter("amount > 100").limit(1).select(F.to_json(F.struct("*"))).first()[0]
    (path / "extra-1.txt").write_text("garbage\n")
    (path / "extra-2.txt").write_text(repeated + "\n")
    return path


def _settings(tmp_path):
    return Settings(lake_root=str(tmp_path / "lake"), archive_trigger=runner.AVAILABLE_NOW,
                    alert_trigger=runner.AVAILABLE_NOW)


def _run(spark, folder, settings, score=with_rule_prediction):
    stream = ms.file_stream(spark, str(folder), max_files_per_trigger=2)
    queries = runner.start_all(spark, stream, settings, score, F.lit(DATE))
    runner.finish(queries)
    return queries


def _same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_streams_equal_batch(spark, small, folder, tmp_path):
    settings = _settings(tmp_path)
    _run(spark, folder, settings)
    txns = transactions(spark, small)
    archive = spark.read.parquet(settings.archive_path).drop("kafka_timestamp")
    assert archive.count() == txns.count() + 1  # the re-sent copy is archived as well
    assert _same(archive.distinct(), with_features(txns, F.lit(DATE)))
    alerts = AlertStore(spark, settings.alerts_path).read()
    expected = txns.filter("amount > 100")
    assert _same(alerts.select("transaction_id", "amount", "category", "state"),
                 expected.select("transaction_id", "amount", "category", "state"))
    bad = spark.read.parquet(settings.bad_records_path).collect()
    assert [r.raw_value for r in bad] == ["garbage"]
    progress = batch_progress(spark.read.parquet(settings.progress_path)).orderBy("batch_id").collect()
    assert len(progress) == 3 and progress[-1].cum_n == txns.count() + 1
    assert progress[-1].cum_alerts == expected.count() + 1


def test_restart_continues_after_the_last_batch(spark, small, folder, tmp_path):
    settings = _settings(tmp_path)
    _run(spark, folder, settings)
    before = spark.read.parquet(settings.archive_path).count()
    _run(spark, folder, settings)
    assert spark.read.parquet(settings.archive_path).count() == before
    late = json.dumps({"transaction_id": "late", "transaction_time": "2024-01-01T10:00:00", "amount": 900.0})
    (folder / "late.txt").write_text(late + "\n")
    _run(spark, folder, settings)
    assert spark.read.parquet(settings.archive_path).count() == before + 1
    assert not AlertStore(spark, settings.alerts_path).read().filter("transaction_id = 'late'").isEmpty()


def test_alerts_survive_a_lost_checkpoint(spark, small, folder, tmp_path):
    settings = _settings(tmp_path)
    _run(spark, folder, settings)
    before = AlertStore(spark, settings.alerts_path).read().drop("detected_at")
    expected = before.collect()
    shutil.copytree(settings.alerts_path, str(tmp_path / "kept"))
    fresh = Settings(lake_root=str(tmp_path / "lake2"), archive_trigger=runner.AVAILABLE_NOW,
                     alert_trigger=runner.AVAILABLE_NOW)
    shutil.copytree(str(tmp_path / "kept"), fresh.alerts_path)
    _run(spark, folder, fresh)  # no checkpoint there: batch numbers start at 0 again
    after = AlertStore(spark, fresh.alerts_path).read().drop("detected_at")
    assert sorted(map(str, after.collect())) == sorted(map(str, expected))


def test_without_a_scorer_only_the_archive_runs(spark, folder, tmp_path):
    settings = _settings(tmp_path)
    names = {q.name for q in _run(spark, folder, settings, score=None)}
    assert names == {"archive", "quarantine"}
    assert AlertStore(spark, settings.alerts_path).read().isEmpty()


def _broken(batch):
    raise RuntimeError("scoring failed")


def _alert_query(spark, folder, tmp_path, on_batch):
    stream = runner.enriched(ms.file_stream(spark, str(folder)), F.lit(DATE))
    return runner.start_alerts(stream, on_batch, str(tmp_path / "checkpoint"), runner.AVAILABLE_NOW)


def test_a_failing_batch_stops_the_query_and_is_retried(spark, folder, tmp_path):
    store = AlertStore(spark, str(tmp_path / "alerts"))
    with pytest.raises(Exception, match="scoring failed"):
        runner.finish([_alert_query(spark, folder, tmp_path, runner.AlertBatch(_broken, store))])
    assert store.read().isEmpty()
    runner.finish([_alert_query(spark, folder, tmp_path, runner.AlertBatch(with_rule_prediction, store))])
    assert not store.read().isEmpty()


def test_a_batch_without_alerts_leaves_no_folder(spark, small, folder, tmp_path):
    store = AlertStore(spark, str(tmp_path / "alerts"))
    never = lambda batch: batch.withColumn("prediction", (F.col("amount") > 1e9).cast("double"))
    nothing = runner.AlertBatch(never, store, progress_path=str(tmp_path / "progress"))
    runner.finish([_alert_query(spark, folder, tmp_path, nothing)])
    assert not list((tmp_path / "alerts").rglob("*.parquet")) and store.read().isEmpty()
    assert spark.read.parquet(str(tmp_path / "progress")).first().n == transactions(spark, small).count() + 1


def test_an_empty_batch_writes_nothing(spark, folder, tmp_path):
    batch = runner.enriched(ms.file_messages(spark, str(folder)), F.lit(DATE)).filter("false")
    on_batch = runner.AlertBatch(with_rule_prediction, AlertStore(spark, str(tmp_path / "alerts")),
                                 progress_path=str(tmp_path / "progress"))
    on_batch(batch, 0)
    assert not list((tmp_path / "alerts").rglob("*.parquet")) and not (tmp_path / "progress").exists()


def test_alerts_are_gathered_into_few_files(spark, folder, tmp_path):
    store = AlertStore(spark, str(tmp_path / "alerts"))
    runner.finish([_alert_query(spark, folder, tmp_path, runner.AlertBatch(with_rule_prediction, store))])
    (batch,) = (tmp_path / "alerts" / "log").iterdir()
    assert len(list(batch.rglob("*.parquet"))) == 1


def test_one_failing_query_ends_the_wait_and_stops_the_others(spark, folder, tmp_path):
    spark.streams.resetTerminated()
    transactions_ = runner.enriched(ms.file_stream(spark, str(folder)), F.lit(DATE))
    store = AlertStore(spark, str(tmp_path / "alerts"))
    archive = runner.start_archive(transactions_, str(tmp_path / "a"), str(tmp_path / "c1"), "1 second")
    alerts = runner.start_alerts(transactions_, runner.AlertBatch(_broken, store), str(tmp_path / "c2"), "1 second")
    with pytest.raises(Exception, match="scoring failed"):
        runner.run_until_stopped(spark, [archive, alerts])
    assert not archive.isActive and not alerts.isActive


def test_dead_letters_keep_the_failing_batch(spark, small, folder, tmp_path):
    store = AlertStore(spark, str(tmp_path / "alerts"))
    dead = str(tmp_path / "dead")
    on_batch = runner.AlertBatch(_broken, store, dead_letter_path=dead)
    runner.finish([_alert_query(spark, folder, tmp_path, on_batch)])
    assert spark.read.parquet(dead).count() == transactions(spark, small).count() + 2


def test_resent_ids_are_dropped_within_the_watermark(spark, folder, small, tmp_path):
    stream = ms.parse_messages(ms.file_stream(spark, str(folder), max_files_per_trigger=2))
    unique = drop_resent(stream.filter("transaction_id is not null"), lateness="60 days")
    writer = unique.writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "cp"))
    runner.finish([writer.trigger(availableNow=True).start()])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("transaction_id").distinct().count() == transactions(spark, small).count()


def _joint(spark, folder, settings, score=with_rule_prediction):
    stream = ms.file_stream(spark, str(folder), max_files_per_trigger=2)
    queries = runner.start_joint(spark, stream, settings, score, F.lit(DATE))
    runner.finish(queries)
    return queries


def test_one_query_feeds_all_sinks(spark, small, folder, tmp_path):
    settings, txns = _settings(tmp_path), transactions(spark, small)
    (query,) = _joint(spark, folder, settings)
    read = sum(p.numInputRows for p in query.recentProgress)
    assert read == txns.count() + 2  # each message is read once, for all sinks
    archive = read_archive(spark, settings.archive_path).drop("kafka_timestamp")
    assert archive.count() == txns.count() + 1 and _same(archive.distinct(), with_features(txns, F.lit(DATE)))
    alerts = AlertStore(spark, settings.alerts_path).read()
    assert alerts.count() == txns.filter("amount > 100").count()
    assert [r.raw_value for r in spark.read.parquet(settings.bad_records_path).collect()] == ["garbage"]
    progress = runner.read_progress(spark, settings.progress_path).collect()
    assert sum(r.n for r in progress) == txns.count() + 1 and sum(r.bad for r in progress) == 1
    assert all(r.seconds > 0 and r.rows_per_second > 0 for r in progress)
    runner.compact_progress(spark, settings.progress_path)
    assert sorted(runner.read_progress(spark, settings.progress_path).collect()) == sorted(progress)
    with pytest.raises(ValueError, match="file stream"):
        (tmp_path / "lake/archive/transactions/_spark_metadata").mkdir()
        _joint(spark, folder, settings)


def test_a_replayed_joint_batch_changes_nothing(spark, small, folder, tmp_path):
    lake = _settings(tmp_path)
    store = AlertStore(spark, lake.alerts_path, run_id=1)
    on_batch = runner.JointBatch(runner.AlertBatch(with_rule_prediction, store, lake.progress_path), lake.archive_path,
                                 lake.bad_records_path, F.lit(DATE))
    messages = ms.file_messages(spark, str(folder))
    for _ in range(2):
        on_batch(messages, 0)
    assert read_archive(spark, lake.archive_path).count() == transactions(spark, small).count() + 1
    assert spark.read.parquet(lake.bad_records_path).count() == runner.read_progress(spark, lake.progress_path).count() == 1
    on_batch(messages.limit(0), 1)
    assert runner.read_progress(spark, lake.progress_path).count() == 1


def test_messages_that_are_no_transactions_are_kept_as_small_as_they_are(spark, tmp_path, monkeypatch):
    """Many short foreign messages in one task: no column of the transaction they are not is kept for them."""
    lake, n, kept = _settings(tmp_path), 20_000, []

    def write_and_look(*args):
        write_archive_batch(*args)
        kept.extend(r.memSize() + r.diskSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo() if r.isCached())

    monkeypatch.setattr(runner, "write_archive_batch", write_and_look)
    store = AlertStore(spark, lake.alerts_path, run_id=1)
    on_batch = runner.JointBatch(runner.AlertBatch(with_rule_prediction, store, lake.progress_path), lake.archive_path,
                                 lake.bad_records_path, F.lit(DATE))
    foreign = F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("value")
    on_batch(spark.range(0, n, 1, 1).select(foreign, F.current_timestamp().alias("timestamp")), 0)
    assert spark.read.parquet(lake.bad_records_path).groupBy("missing").count().first()["count"] == n
    assert kept and max(kept) < 40 * n


def test_archive_files_are_bounded_and_a_finished_day_is_merged(spark, small, folder, tmp_path):
    """Rows in random order: a batch adds one small file to each day it touches, not one per task."""
    lake = _settings(tmp_path)
    days = transactions(spark, small).select(F.to_date("transaction_time").alias("d")).distinct().count()
    _joint(spark, folder, lake)
    files = list((tmp_path / "lake/archive").rglob("*.parquet"))
    assert len(files) <= 3 * days  # three batches of two files each
    day = dt.date(2024, 1, 2)
    before = sorted(map(str, read_archive(spark, lake.archive_path, day, day).collect()))
    assert compact_archive_day(spark, lake.archive_path, day) > 1 and before
    assert sorted(map(str, read_archive(spark, lake.archive_path, day, day).collect())) == before
    assert len(list((tmp_path / f"lake/archive/transactions/date={day}").rglob("*.parquet"))) == 1
    assert compact_archive_day(spark, lake.archive_path, day) == 1


def test_settings_turn_on_dead_letters_and_duplicate_removal(spark, small, folder, tmp_path):
    lake = Settings.from_env({"LAKE_ROOT": str(tmp_path / "lake"), "ALERT_TRIGGER": runner.AVAILABLE_NOW, "DEAD_LETTERS": "yes",
                              "ARCHIVE_TRIGGER": runner.AVAILABLE_NOW, "DROP_RESENT_WITHIN": "90 days"})
    assert Settings.from_env({}).dead_letter_path is None
    _joint(spark, folder, lake, _broken)
    assert read_archive(spark, lake.archive_path).count() == transactions(spark, small).count()  # sent twice, kept once
    assert spark.read.parquet(lake.dead_letter_path).filter("transaction_id is not null").count() == transactions(spark, small).count()
    other = Settings.from_env({"LAKE_ROOT": str(tmp_path / "lake2"), "ALERT_TRIGGER": runner.AVAILABLE_NOW, "DEAD_LETTERS": "1",
                               "ARCHIVE_TRIGGER": runner.AVAILABLE_NOW, "DROP_RESENT_WITHIN": "90 days"})
    _run(spark, folder, other, _broken)
    assert spark.read.parquet(other.archive_path).count() == transactions(spark, small).count()
    assert spark.read.parquet(other.dead_letter_path).count() == transactions(spark, small).count()


def test_missing_model_means_archive_only(spark, tmp_path):
    assert runner.load_model(str(tmp_path / "nothing")) is None
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    with pytest.raises(Exception):
        runner.load_model(str(tmp_path / "broken"))

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskstream.operators.alerts import alert_projection
from riskstream.schema import ALERT_COLUMNS, TRANSACTION_SCHEMA
from riskstream.sinks.alert_store import AlertStore, run_id_of

DAY = dt.datetime(2024, 3, 1, 12)


def scored(spark, rows):
    """Positives from (transaction id, amount) or (id, amount, arrival)."""
    base = spark.createDataFrame(
        [(r[0], float(r[1]), r[2] if len(r) > 2 else None) for r in rows],
        "transaction_id string, amount double, kafka_timestamp timestamp",
    )
    others = [f for f in TRANSACTION_SCHEMA if f.name not in base.columns]
    return base.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others],
                       F.lit(1.0).alias("prediction"))


def write(store, rows, batch, when=DAY):
    extra = ("kafka_timestamp",)
    store.write_batch(alert_projection(scored(store.spark, rows), F.lit(when), extra), batch)


def content(store, as_of=DAY):
    return {r.transaction_id: r.amount for r in store.read(F.lit(as_of)).collect()}


def test_unwritten_store_is_empty(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path / "none"))
    assert content(store) == {} and store.purge(DAY) == 0
    assert set(ALERT_COLUMNS) <= set(store.read().columns)


def test_later_batch_wins_and_replays_change_nothing(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 1), ("b", 1)], 0)
    write(store, [("a", 2)], 1)
    assert content(store) == {"a": 2, "b": 1}
    write(store, [("a", 2)], 1)
    assert content(store) == {"a": 2, "b": 1} and store.versions().count() == 3
    write(store, [("a", 1), ("b", 1)], 0, DAY + dt.timedelta(hours=1))
    assert content(store) == {"a": 2, "b": 1}


def test_replay_replaces_the_whole_batch(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 1), ("b", 1)], 0)
    write(store, [("a", 1)], 0)
    assert content(store) == {"a": 1}


def test_duplicate_inside_a_batch_keeps_the_last_arrival(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 2, DAY + dt.timedelta(seconds=9)), ("a", 1, DAY), ("a", 0)], 0)
    assert content(store) == {"a": 2}


def test_new_run_with_restarted_batch_numbers_wins(spark, tmp_path):
    old, new = AlertStore(spark, str(tmp_path), run_id=1), AlertStore(spark, str(tmp_path), run_id=2)
    write(old, [("a", 1)], 7)
    write(old, [("b", 1)], 0)
    write(new, [("a", 2)], 0)
    assert content(new) == {"a": 2, "b": 1}


def test_half_written_batch_is_finished_by_its_replay(spark, tmp_path):
    """A crash after the write and before the commit: the same batch comes again."""
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 1)], 0)
    again = AlertStore(spark, str(tmp_path), run_id=2)  # the restarted job has a new run id
    write(again, [("a", 1), ("b", 1)], 0)
    assert content(again) == {"a": 1, "b": 1}


def test_retention_and_purge(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("old", 1), ("renewed", 1)], 0, DAY - dt.timedelta(days=31))
    write(store, [("kept", 1), ("renewed", 2)], 1, DAY - dt.timedelta(days=29))
    assert content(store) == {"kept": 1, "renewed": 2}
    assert store.purge(DAY) == 0 and store.compact() == 2 and content(store) == {"kept": 1, "renewed": 2}
    assert store.purge(DAY) == 1 and store.purge(DAY) == 0
    assert content(store) == {"kept": 1, "renewed": 2} and store.versions().count() == 2


def test_expired_winner_does_not_revive_a_replaced_row(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 2)], 1, DAY - dt.timedelta(days=31))
    write(store, [("a", 1)], 0, DAY - dt.timedelta(days=1))
    assert content(store) == {}


def test_compaction_keeps_the_rows_and_their_order(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 1)]]):
        write(store, rows, batch)
    write(store, [("d", 1)], 3, DAY + dt.timedelta(days=1))
    assert store.compact(keep_newest=True) == 3
    parts = {r.part for r in store.versions().select("part").distinct().collect()}
    assert parts == {"current", "r1-b3"} and content(store, DAY) == {"a": 2, "b": 1, "c": 1, "d": 1}
    write(store, [("a", 1), ("b", 1)], 0)
    assert content(store)["a"] == 2
    assert store.compact() == 2 and content(store) == {"a": 2, "b": 1, "c": 1, "d": 1} and store.versions().count() == 4
    assert store.compact() == 0


def test_rows_move_between_days_when_merged(spark, tmp_path):
    store, earlier = AlertStore(spark, str(tmp_path), run_id=1), DAY - dt.timedelta(days=3)
    write(store, [("a", 1), ("b", 1)], 0, earlier)
    store.compact()
    write(store, [("a", 2)], 1)
    write(store, [("b", 2)], 2)
    store.compact()
    days = sorted(p.name for p in (tmp_path / "current").iterdir() if p.name.startswith("day="))
    assert days == [f"day={DAY:%Y-%m-%d}"] and content(store) == {"a": 2, "b": 2} and store.versions().count() == 2


def test_merged_batches_stay_for_running_readers(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 1)], 0)
    write(store, [("a", 2)], 1)
    reader = store.read(F.lit(DAY))
    assert store.compact(grace=dt.timedelta(hours=1)) == 0
    assert [r.amount for r in reader.collect()] == [2] and content(store) == {"a": 2}
    assert store.compact() == 2 and content(store) == {"a": 2}


def test_filters_and_days_reach_the_merged_table(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("a", 1), ("b", 5)], 0)
    store.compact()
    for more in (False, True):
        if more:
            write(store, [("a", 2)], 1)
        rows = store.read(F.lit(DAY)).filter("category = 'travel'")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line or "PushedFilters" in line or "PartitionFilters" in line]
        assert any("EqualTo(category,travel)" in line and "day" in line.partition("PartitionFilters")[2] for line in scans), plan
        assert "Window" not in plan or more
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path), run_id=1)
    write(store, [("hot", n) for n in range(500)] + [("x", 1)], 0)
    current = store.read(F.lit(DAY))
    assert current.count() == 2
    plan = current._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_fully_purged_store_stays_usable(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path / "s"), run_id=1)
    write(store, [("a", 1)], 0, DAY - dt.timedelta(days=40))
    store.compact()
    assert store.purge(DAY) == 1 and store.purge(DAY) == 0 and content(store) == {}
    write(store, [("a", 2)], 1)
    assert content(store) == {"a": 2}


def test_purge_revives_no_replaced_alert(spark, tmp_path):
    store, old = AlertStore(spark, str(tmp_path / "s"), run_id=1), DAY - dt.timedelta(days=40)
    write(store, [("a", 1)], 0, old)
    write(store, [("a", 2)], 1, old)
    write(store, [("b", 3)], 2, old)
    write(store, [("a", 1)], 0)  # batch 0 again, younger than the batch that replaced it
    assert content(store) == {}
    store.compact()
    assert store.purge(DAY) == 1 and content(store) == {}  # b's day; the winner over batch 0 stays, unseen
    write(store, [("a", 1)], 0)
    assert content(store) == {} and store.compact() == 1 and content(store) == {}
    later = DAY + dt.timedelta(days=40)
    assert store.purge(later) == 1 and content(store, later) == {} and store.versions().count() == 0


def test_a_run_keeps_its_id_over_restarts(spark, tmp_path):
    first, again = run_id_of(spark, str(tmp_path / "c")), run_id_of(spark, str(tmp_path / "c"))
    assert first == again and run_id_of(spark, str(tmp_path / "d")) > first

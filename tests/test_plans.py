"""Plan shapes that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from riskstream.operators import alerts as al
from riskstream.operators import stats as st
from riskstream.operators.quality import latest_by_key
from riskstream.plans.registry import QUERIES
from riskstream.plans.transactions import transactions
from riskstream.sinks.files import write_archive
from riskstream.sources.tables import read_archive

LAZY = sorted(set(QUERIES) - {q for q in QUERIES if q.startswith("train_")} - {"model_comparison"})


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["features_all", "alert_projection", "shape_record", "to_json_records"])
def test_row_queries_do_not_shuffle_by_key(spark, small, name):
    assert "hashpartitioning" not in plan(QUERIES[name](spark, small))


def test_only_needed_columns_are_read(spark, small):
    text = plan(transactions(spark, small).select("transaction_id", "amount"))
    events = re.search(r"ReadSchema: (struct<event_id[^>]*>)", text).group(1)
    assert events == "struct<event_id:bigint,user_id:bigint,value:double>"


def test_alert_filters_reach_the_scan(spark, tmp_path):
    spark.sql("select 'a' as transaction_id, current_timestamp() as transaction_time, 1.0D as amount, "
              "'m' as merchant, 'travel' as category, '' as cc_num, '' as first, '' as last, 'CA' as state, "
              "'' as city, 1.0D as is_fraud, current_timestamp() as detected_at").write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    text = plan(al.list_alerts(stored, 10, "travel", "CA"))
    assert "EqualTo(category,travel)" in text and "EqualTo(state,CA)" in text and "TakeOrderedAndProject" in text


def test_archive_reads_only_the_wanted_days(spark, tmp_path):
    days = spark.sql("select id, date_add(date'2024-01-01', cast(id % 5 as int)) as date from range(50)")
    write_archive(days, str(tmp_path / "a"))
    import datetime as dt

    text = plan(read_archive(spark, str(tmp_path / "a"), dt.date(2024, 1, 2), dt.date(2024, 1, 2)))
    assert re.search(r"PartitionFilters: \[.*date", text)


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.expr("if(id < 900, 'hot', string(id))").alias("k"), "id")
    text = plan(latest_by_key(rows, "k", [F.desc("id")]))
    partial, exchange = text.index("row_number(), 1, Partial"), text.index("Exchange hashpartitioning")
    assert partial > exchange  # deeper in the printed tree = earlier in the flow


def test_statistics_read_the_alerts_once(spark, tmp_path):
    spark.range(100).select(F.lit("c").alias("category"), F.lit("s").alias("state"),
                            F.col("id").cast("double").alias("amount")).write.parquet(str(tmp_path / "a"))
    text = plan(st.alert_stats_maps(spark.read.parquet(str(tmp_path / "a"))))
    assert text.count("FileScan") == 1


def test_hot_customer_is_split_when_dimensions_are_large(spark, tmp_path):
    """No broadcasts allowed, a third of all events from one customer: the joins split it."""
    from riskstream.plans.transactions import table

    source = "/root/testdata/sf0.01"
    hot = F.expr("if(event_id % 3 = 0, 7L, event_id % 140)")
    table(spark, source, "events").withColumn("user_id", hot).repartition(8).write.parquet(
        str(tmp_path / "events.parquet"))
    for name in ("customer", "nation", "supplier"):
        table(spark, source, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    adaptive = "spark.sql.adaptive."
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", adaptive + "autoBroadcastJoinThreshold": "-1",
        adaptive + "skewJoin.skewedPartitionThresholdInBytes": "4KB",
        adaptive + "skewJoin.skewedPartitionFactor": "2", adaptive + "advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for key, value in options.items():
            spark.conf.set(key, value)
        joined = transactions(spark, str(tmp_path)).select("transaction_id", "last", "state", "merchant")
        assert len({r.transaction_id for r in joined.collect()}) == 10_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filtering_parsed_messages_parses_once(spark):
    from riskstream.operators.quality import is_bad
    from riskstream.sources.messages import parse_messages

    raw = spark.range(3).select(F.col("id").cast("string").alias("value"), F.current_timestamp().alias("timestamp"))
    assert plan(parse_messages(raw).filter(~is_bad())).count("from_json(") == 1


def test_archive_splits_a_hot_day(spark, tmp_path):
    from pathlib import Path

    rows = spark.range(60_000).select(
        F.expr("uuid()").alias("text"),
        F.expr("if(id % 10 > 0, date'2024-01-01', date_add(date'2024-01-02', cast(id % 7 as int)))").alias("date"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "200KB")
        write_archive(rows, str(tmp_path / "a"))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(tmp_path / "a").glob("date=*")}
    # A day that shares the hot day's hash partition is split along with it; the rest have one file.
    assert files["date=2024-01-01"] > 3 and sorted(files.values())[-3] == 1
    assert spark.read.parquet(str(tmp_path / "a")).count() == 60_000


def test_running_totals_scan_once(spark, small):
    progress = QUERIES["batch_progress"](spark, small)
    progress.collect()
    assert "ReusedExchange" in plan(progress)

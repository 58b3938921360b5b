from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from riskstream.operators import columns as cl
from riskstream.operators.quality import split_bad
from riskstream.plans.transactions import replay_file_rows, transactions
from riskstream.schema import CSV_INDEX_COLUMN, TRAINING_CSV_SCHEMA, TRANSACTION_SCHEMA
from riskstream.sinks.files import write_archive, write_csv
from riskstream.sources.messages import parse_messages
from riskstream.sources.tables import read_archive, read_training_csv

ARRIVED = dt.datetime(2024, 1, 1)


def _parse(spark, *texts, **kw):
    frame = spark.createDataFrame([(t, ARRIVED) for t in texts], "value string, timestamp timestamp")
    return parse_messages(frame, **kw)


def test_valid_message(spark):
    text = json.dumps({"transaction_id": "a", "transaction_time": "2020-01-01T10:00:00", "amount": 1.5,
                       "city_pop": 3})
    row = _parse(spark, text).first()
    assert (row.transaction_id, row.amount, row.city_pop) == ("a", 1.5, 3)
    assert row.transaction_time == dt.datetime(2020, 1, 1, 10) and row.kafka_timestamp == ARRIVED


def test_bytes_are_accepted(spark):
    frame = spark.createDataFrame([(bytearray(b'{"transaction_id":"a"}'), ARRIVED)],
                                  "value binary, timestamp timestamp")
    assert parse_messages(frame).first().transaction_id == "a"


def test_wrong_types_null_the_field_only(spark):
    row = _parse(spark, '{"transaction_id":5,"amount":"1.5","city_pop":3.7,"transaction_time":"zzz"}').first()
    assert row.transaction_id == "5"
    assert row.amount is None and row.city_pop is None and row.transaction_time is None


def test_quarantine(spark):
    good = '{"transaction_id":"a","transaction_time":"2020-01-01T10:00:00","amount":1.5}'
    nan = '{"transaction_id":"n","transaction_time":"2020-01-01T10:00:00","amount":NaN}'
    fine, bad = split_bad(_parse(spark, good, nan, "garbage", None, '{"transaction_id":"only"}', keep_raw=True))
    amounts = {r.transaction_id: r.amount for r in fine.collect()}
    assert amounts["a"] == 1.5 and math.isnan(amounts["n"])
    reasons = {r.raw_value: r.missing for r in bad.collect()}
    everything = "transaction_id,transaction_time,amount"
    assert reasons == {"garbage": everything, None: everything,
                       '{"transaction_id":"only"}': "transaction_time,amount"}


def test_records_survive_the_wire(spark, small):
    txns = transactions(spark, small)
    sent = cl.to_messages(cl.shape_record(replay_file_rows(txns)))
    assert sent.columns == ["key", "value"]
    back = parse_messages(sent.withColumn("timestamp", F.lit(ARRIVED))).drop("kafka_timestamp")
    assert back.exceptAll(txns).isEmpty() and txns.exceptAll(back).isEmpty()


def test_normalize_keeps_existing_targets(spark):
    both = spark.createDataFrame([(1.0, 2.0)], "amt double, amount double")
    assert cl.normalize_columns(both).columns == ["amt", "amount"]
    assert cl.normalize_columns(spark.range(1)).columns == ["id"]


@pytest.mark.parametrize("text, label", [("1", 1), ("0", 0), ("yes", None), (None, None)])
def test_label(spark, text, label):
    frame = spark.createDataFrame([(text,)], "is_fraud string")
    assert cl.with_label(frame).first().label == label


def test_drop_index_column_is_harmless_without_one(spark):
    assert cl.drop_index_column(spark.range(2)).columns == ["id"]


def test_csv_round_trip_with_index_and_shuffled_columns(spark, small, tmp_path):
    rows = replay_file_rows(transactions(spark, small)).withColumn(CSV_INDEX_COLUMN, F.lit(7))
    order = [CSV_INDEX_COLUMN, *reversed(TRAINING_CSV_SCHEMA.names)]
    write_csv(rows.select(*order), str(tmp_path / "csv"))
    back = read_training_csv(spark, str(tmp_path / "csv"))
    assert back.columns == order
    clean = cl.drop_index_column(back).select(*TRAINING_CSV_SCHEMA.names)
    expected = rows.select(*TRAINING_CSV_SCHEMA.names)
    assert clean.exceptAll(expected).isEmpty() and clean.count() == expected.count()


def test_csv_text_columns_keep_zeros_and_size(spark, tmp_path):
    header = ",".join(TRAINING_CSV_SCHEMA.names)
    values = dict.fromkeys(TRAINING_CSV_SCHEMA.names, "")
    values |= {"zip": "00042", "cc_num": "123456789012345678901", "amt": "1.5", "state": '""'}
    (tmp_path / "in.csv").write_text(header + "\n" + ",".join(values[n] for n in TRAINING_CSV_SCHEMA.names) + "\n")
    row = read_training_csv(spark, str(tmp_path / "in.csv")).first()
    assert (row.zip, row.cc_num, row.amt, row.state, row.city) == ("00042", "123456789012345678901", 1.5, "", None)


def test_csv_with_an_unnamed_index_column(spark, tmp_path):
    names = TRAINING_CSV_SCHEMA.names
    row = ["0", *["2019-01-01 00:00:18" if n == "trans_date_trans_time" else "1" for n in names]]
    (tmp_path / "in.csv").write_text("," + ",".join(names) + "\n" + ",".join(row) + "\n")
    clean = cl.drop_index_column(read_training_csv(spark, str(tmp_path / "in.csv")))
    assert clean.columns == names
    got = cl.normalize_columns(clean).first()
    assert got.transaction_id == "1" and got.amount == 1.0
    assert got.transaction_time == dt.datetime(2019, 1, 1, 0, 0, 18)


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    names = TRAINING_CSV_SCHEMA.names
    for file, order in (("a.csv", names), ("b.csv", names[::-1]), ("c.csv", ["", *names]), ("d.csv", ["", *names[::-1]])):
        values = {n: f"{n} of {file}" for n in names if n in ("merchant", "category", "trans_num")}
        cells = [values.get(n, "1") for n in order]
        (tmp_path / file).write_text(",".join(order) + "\n" + ",".join(cells) + "\n")
    rows = read_training_csv(spark, str(tmp_path)).orderBy("trans_num").collect()
    assert [(r.trans_num, r.merchant, r.category) for r in rows] == [
        tuple(f"{n} of {f}.csv" for n in ("trans_num", "merchant", "category")) for f in "abcd"]
    (tmp_path / "e.csv").write_text("1,2\n")
    with pytest.raises(ValueError, match="e.csv"):
        read_training_csv(spark, str(tmp_path))


def test_csv_cells_that_do_not_fit_are_kept_as_text(spark, tmp_path):
    names = TRAINING_CSV_SCHEMA.names
    rows = [["much" if n == "amt" and bad else "1" for n in names] for bad in (True, False)]
    (tmp_path / "a.csv").write_text("\n".join(map(",".join, [names, *rows])) + "\n")
    got = read_training_csv(spark, str(tmp_path), bad_rows="bad").select("amt", "bad").collect()
    assert {(r.amt, r.bad) for r in got} == {(1.0, None), (None, ",".join(rows[0]))}


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    (tmp_path / "in.csv").write_text("trans_num,amt\na,1\n")
    with pytest.raises(ValueError, match="cc_num"):
        read_training_csv(spark, str(tmp_path / "in.csv"))


def test_archive_prunes_days(spark, tmp_path):
    days = spark.sql("select id, date_add(date'2024-01-01', cast(id % 5 as int)) as date from range(50)")
    write_archive(days, str(tmp_path / "a"))
    window = read_archive(spark, str(tmp_path / "a"), dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert window.count() == 20
    plan = window._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_replay_order_is_a_permutation_and_repeatable(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"))
    first = [r[0] for r in cl.replay_order(ids).collect()]
    again = [r[0] for r in cl.replay_order(ids.repartition(3)).collect()]
    other = [r[0] for r in cl.replay_order(ids, seed=7).collect()]
    assert first == again and sorted(first) == sorted(other) and first != other


def test_wire_has_23_fields():
    assert len(TRANSACTION_SCHEMA) == 23

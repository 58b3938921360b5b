"""Named queries over the star-schema tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.config import Settings
from riskstream.functions import scalars
from riskstream.operators import alerts as al
from riskstream.operators import columns as cl
from riskstream.operators import features as ft
from riskstream.operators import lookup as lk
from riskstream.operators import metrics as mt
from riskstream.operators import ordered as od
from riskstream.operators import quality as ql
from riskstream.operators import sampling as sm
from riskstream.operators import stats as st
from riskstream.plans import training as tr
from riskstream.plans.transactions import (
    replay_file_rows, table, transactions, with_rule_prediction,
)
from riskstream.schema import (
    ALERT_COLUMNS, CSV_INDEX_COLUMN, NUMERIC_FEATURES, ONE_HOT_COLUMNS, TRAINING_CSV_SCHEMA, TRANSACTION_SCHEMA,
)
from riskstream.session import fresh_folder, remove_folder
from riskstream.sinks import files
from riskstream.sinks.alert_store import AlertStore
from riskstream.sources import messages as ms
from riskstream.sources import tables as tb
from riskstream.streaming import runner

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2024, 6, 30)
FIRST_BATCH_CLOCK = "2024-01-05 00:00:00"
SECOND_BATCH_CLOCK = "2024-02-05 00:00:00"
REPLAY_CLOCK = "2024-02-07 00:00:00"
THIRD_BATCH_CLOCK = "2024-02-08 00:00:00"
LATE_PURGE = dt.datetime(2024, 3, 7, tzinfo=dt.timezone.utc)
STREAM_READ_AT = "2024-01-30 00:00:00"
RETENTION_AS_OF = "2024-02-10 00:00:00"
# The wire columns that a training file has, under their wire names.
TRAINING_ROW = [c for c in TRANSACTION_SCHEMA.names if c != "hour_of_day"]
SWEEP = [i / 10 for i in range(1, 10)]


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def pinned(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        QUERIES[name] = pinned
        return pinned

    return register


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _as_of() -> Column:
    return F.lit(AS_OF)


def _at(clock: str) -> Column:
    """A fixed moment in the session's time zone, whatever the machine's own is."""
    return F.lit(clock).cast("timestamp")


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alert rows of the high-value rule, detected three seconds after the transaction."""
    detected = F.col("transaction_time") + F.expr("interval 3 seconds")
    return al.alert_projection(with_rule_prediction(transactions(spark, folder)), detected)


# ------------------------------------------------------------------ features

def _feature_query(name: str, build: Callable[[DataFrame], dict], round_: tuple[str, ...] = ()) -> None:
    @query(name)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        txns = transactions(spark, folder)
        derived = build(txns)
        picked = txns.select("transaction_id", *[c.alias(n) for n, c in derived.items()])
        return _rounded(picked, *round_)


_feature_query("feat_amount", lambda t: ft.amount_features(), ("amount_log",))
_feature_query("feat_age", lambda t: ft.age_feature(_as_of()))
_feature_query("feat_gender", lambda t: ft.gender_feature())
_feature_query("feat_temporal", lambda t: ft.temporal_features())
_feature_query("feat_distance", lambda t: ft.distance_feature(t.columns), ("distance_customer_merchant",))
_feature_query("feat_constant", lambda t: ft.out_of_state_feature())
_feature_query("feat_category_onehot", lambda t: ft.category_one_hot())
_feature_query("feat_pop_ratio", lambda t: ft.population_ratio())
_feature_query("feat_night", lambda t: ft.night_feature())
_feature_query("feat_cyclic", lambda t: ft.cyclic_features(), ("hour_sin", "hour_cos"))
_feature_query("feat_amount_bucket", lambda t: ft.amount_bucket())


@query("feat_date")
def feat_date(spark, folder):
    return transactions(spark, folder).select(
        "transaction_id", *[c.cast("string").alias(n) for n, c in ft.date_feature().items()]
    )


@query("feat_interactions")
def feat_interactions(spark, folder):
    derived = ft.interaction_features()
    core = ft.with_features(transactions(spark, folder), _as_of())
    picked = core.select("transaction_id", *[c.alias(n) for n, c in derived.items()])
    return picked


@query("feat_category_risk")
def feat_category_risk(spark, folder):
    train, _ = sm.train_test(transactions(spark, folder))
    scored = lk.with_category_risk(transactions(spark, folder), lk.category_risk(train))
    return _rounded(
        scored.select("transaction_id", "category_risk_score", "risk_amount_interaction"),
        "category_risk_score", "risk_amount_interaction",
    )


def _feature_frame(df: DataFrame) -> DataFrame:
    numeric = [c for c in NUMERIC_FEATURES if c not in ("amount_log", "distance_customer_merchant")]
    return df.select(
        "transaction_id", *numeric, F.round("amount_log", 6).alias("amount_log"),
        F.round("distance_customer_merchant", 6).alias("distance_customer_merchant"),
        "is_out_of_state", *ONE_HOT_COLUMNS, "category", F.col("date").cast("string").alias("date"),
    )


@query("features_all")
def features_all(spark, folder):
    return _feature_frame(ft.with_features(transactions(spark, folder), _as_of()))


# ------------------------------------------------- columns, records, display

@query("normalize_columns")
def normalize_columns(spark, folder):
    return cl.normalize_columns(replay_file_rows(transactions(spark, folder))).select(
        "transaction_id", "transaction_time", "amount"
    )


@query("drop_index_column")
def drop_index_column(spark, folder):
    indexed = replay_file_rows(transactions(spark, folder)).withColumn(
        CSV_INDEX_COLUMN, F.col("unix_time")
    )
    return cl.drop_index_column(indexed)


@query("label_cast")
def label_cast(spark, folder):
    text = F.when(F.col("state") == "", "unknown").otherwise(F.col("is_fraud").cast("string"))
    dirty = transactions(spark, folder).select("transaction_id", text.alias("is_fraud"))
    return cl.with_label(dirty)


@query("shape_record")
def shape_record(spark, folder):
    return cl.shape_record(replay_file_rows(transactions(spark, folder)))


@query("zip_pad")
def zip_pad(spark, folder):
    code = F.col("event_id").cast("string")
    return table(spark, folder, "events").select("event_id", scalars.zip_pad(code).alias("zip"))


@query("to_json_records")
def to_json_records(spark, folder):
    sent = cl.to_messages(cl.shape_record(replay_file_rows(transactions(spark, folder))))
    arrived = sent.withColumn("timestamp", F.current_timestamp())
    return ms.parse_messages(arrived).drop("kafka_timestamp")


@query("parse_json")
def parse_json(spark, folder):
    raw = table(spark, folder, "events").select(
        F.col("props").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )
    return ms.parse_messages(raw, "k INT", keep_raw=True)


@query("alert_projection")
def alert_projection(spark, folder):
    return _alerts(spark, folder)


@query("mask_card")
def mask_card(spark, folder):
    card = F.when(F.col("gender").isNull(), F.lit(None)).when(F.col("state") == "", F.lit("")) \
        .otherwise(F.col("cc_num"))
    return transactions(spark, folder).select("transaction_id", scalars.mask_card(card).alias("card"))


@query("format_amount")
def format_amount(spark, folder):
    return transactions(spark, folder).select(
        "transaction_id",
        scalars.format_amount(F.col("amount")).alias("amount"),
        scalars.format_amount(F.col("unix_time").cast("double")).alias("large"),
    )


@query("alerts_display")
def alerts_display(spark, folder):
    return al.display_alerts(_alerts(spark, folder))


# ---------------------------------------------------------- alert statistics

def _over_alerts(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    @query(name)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(_alerts(spark, folder))


_over_alerts("alert_stats", st.alert_stats)
_over_alerts("alerts_by_category", st.alerts_by_category)
_over_alerts("alerts_by_state", st.alerts_by_state)
_over_alerts("alert_stats_maps", lambda a: st.stats_document(st.alert_stats_maps(a)))
_over_alerts("alert_count", st.alert_count)
_over_alerts("distinct_categories", st.distinct_categories)
_over_alerts("categories_ranked", st.categories_ranked)
_over_alerts("top_states", st.top_states)
_over_alerts("recent_alerts", lambda a: al.list_alerts(a, limit=1000))
_over_alerts("latest_alerts", al.latest_alerts)
_over_alerts("alerts_limit_then_filter",
             lambda a: al.list_alerts(a, 500, "grocery_pos", limit_first=True))
_over_alerts("alerts_filter_then_limit", lambda a: al.list_alerts(a, 500, "grocery_pos"))
_over_alerts("alerts_filter_state", lambda a: al.list_alerts(a, category="travel", state="NATION_7"))


@query("amount_histogram")
def amount_histogram(spark, folder):
    """Alert amounts with a gap and with infinite ones: empty bins show, infinite values have none."""
    amount = F.when(F.col("state") == "", float("inf")).when(F.col("amount").between(300, 420), F.lit(None)).otherwise(F.col("amount"))
    return _rounded(st.histogram(_alerts(spark, folder).withColumn("amount", amount), "amount", 30), "bin_start", "bin_end")


@query("dataset_profile")
def dataset_profile(spark, folder):
    return st.dataset_profile(transactions(spark, folder))


@query("split_counts")
def split_counts(spark, folder):
    tagged = sm.with_split(transactions(spark, folder).select("transaction_id"))
    return sm.split_counts(tagged)


@query("batch_progress")
def batch_progress(spark, folder):
    """Each day of the replay is one batch."""
    day = F.datediff(F.to_date("transaction_time"), F.lit("2024-01-01").cast("date"))
    scored = with_rule_prediction(transactions(spark, folder)).withColumn("batch_id", day)
    return st.batch_progress(st.batch_metrics(scored))


@query("shuffle_replay")
def shuffle_replay(spark, folder):
    return cl.replay_order(transactions(spark, folder))


@query("sample_hash")
def sample_hash(spark, folder):
    return sm.hash_sample(transactions(spark, folder), 0.3).select("transaction_id", "amount", "is_fraud")


@query("split_train_test")
def split_train_test(spark, folder):
    return sm.with_split(transactions(spark, folder)).select("transaction_id", "split")


# -------------------------------------------------------- sources and sinks

@contextmanager
def _replayed(spark: SparkSession, folder: str, more: DataFrame | None = None) -> Iterator[tuple[DataFrame, str]]:
    """The transactions, and ``more`` (value), as a stream of published lines, and a checkpoint folder for it.
    Both folders go once the stream has been drained into its table."""
    published, checkpoint = fresh_folder(spark, "messages"), fresh_folder(spark, "checkpoint")
    records = cl.shape_record(replay_file_rows(transactions(spark, folder)))
    try:
        sent = cl.to_messages(records).select("value")
        files.publish_to_files(sent if more is None else sent.union(more), published)
        yield ms.file_stream(spark, published), checkpoint
    finally:
        remove_folder(spark, published)
        remove_folder(spark, checkpoint)


@query("stream_source")
def stream_source(spark, folder):
    """Every published message through the file stream into a raw landing table."""
    landing = fresh_folder(spark, "landing")
    with _replayed(spark, folder) as (incoming, checkpoint):
        writer = ms.parse_messages(incoming).writeStream.format("parquet") \
            .option("path", landing).option("checkpointLocation", checkpoint)
        runner.finish([writer.trigger(availableNow=True).start()])
    return spark.read.parquet(landing).select(*TRANSACTION_SCHEMA.names)


@query("read_csv")
def read_csv(spark, folder):
    """Two files of one folder with their columns in another order, one with an unnamed index column."""
    path = fresh_folder(spark, "csv")
    rows = replay_file_rows(transactions(spark, folder))
    files.write_csv(rows.filter("amt > 150").select(F.lit(0).alias(" "), *reversed(rows.columns)), f"{path}/swapped")
    files.write_csv(rows.filter("not amt > 150 or amt is null"), f"{path}/plain")
    read = tb.read_training_csv(spark, f"{path}/*")
    return cl.normalize_columns(cl.drop_index_column(read)).drop("trans_date_trans_time").select(*TRAINING_ROW)


@query("csv_bad_rows")
def csv_bad_rows(spark, folder):
    """Rows with a cell that does not fit its column: the cell is null, the text is kept."""
    path = fresh_folder(spark, "csv")
    rows = replay_file_rows(transactions(spark, folder)).select(*TRAINING_CSV_SCHEMA.names)
    broken = F.when(F.col("amt") > 400, F.lit("much")).otherwise(F.col("amt").cast("string"))
    files.write_csv(rows.withColumn("amt", broken), path)
    read = tb.read_training_csv(spark, path, bad_rows="bad")
    return read.select("trans_num", "amt", F.col("bad").isNotNull().alias("is_bad"), F.col("bad").startswith(F.col("trans_num")).alias("kept"))


@query("csv_to_parquet")
def csv_to_parquet(spark, folder):
    source, target = fresh_folder(spark, "csv"), fresh_folder(spark, "parquet")
    files.write_csv(replay_file_rows(transactions(spark, folder)), source)
    files.csv_to_parquet(spark, source, target)
    return spark.read.parquet(target)


@query("archive_scan")
def archive_scan(spark, folder):
    """A ten-day retraining window out of the day-partitioned archive."""
    path = fresh_folder(spark, "archive")
    files.write_archive(ft.with_features(transactions(spark, folder), _as_of()), path)
    window = tb.read_archive(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 19))
    return _feature_frame(window)


@query("archive_stream")
def archive_stream(spark, folder):
    path = fresh_folder(spark, "archive")
    with _replayed(spark, folder) as (incoming, checkpoint):
        featured = runner.enriched(incoming, _as_of())
        runner.finish([runner.start_archive(featured, path, checkpoint, runner.AVAILABLE_NOW)])
    return _feature_frame(spark.read.parquet(path))


@query("alert_stream")
def alert_stream(spark, folder):
    store = AlertStore(spark, fresh_folder(spark, "alerts"))
    detected = F.col("transaction_time") + F.expr("interval 3 seconds")
    on_batch = runner.AlertBatch(with_rule_prediction, store, detected_at=detected)
    with _replayed(spark, folder) as (incoming, checkpoint):
        featured = runner.enriched(incoming, _as_of())
        runner.finish([runner.start_alerts(featured, on_batch, checkpoint, runner.AVAILABLE_NOW)])
    return store.read(_at(STREAM_READ_AT)).select(*ALERT_COLUMNS)


@contextmanager
def _joint(spark: SparkSession, folder: str) -> Iterator[Settings]:
    """The transactions and the events' own JSON, which is no transaction, through one query for all sinks."""
    settings = Settings(lake_root=fresh_folder(spark, "lake"), alert_trigger=runner.AVAILABLE_NOW)
    foreign = table(spark, folder, "events").select(F.col("props").alias("value"))
    with _replayed(spark, folder, foreign) as (incoming, _):
        runner.finish(runner.start_joint(spark, incoming, settings, with_rule_prediction, _as_of()))
    yield settings


@query("joint_archive")
def joint_archive(spark, folder):
    with _joint(spark, folder) as settings:
        return _feature_frame(tb.read_archive(spark, settings.archive_path))


@query("joint_alerts")
def joint_alerts(spark, folder):
    with _joint(spark, folder) as settings:
        return AlertStore(spark, settings.alerts_path).read().select("transaction_id", "amount", "category", "is_fraud")


@query("joint_quarantine")
def joint_quarantine(spark, folder):
    with _joint(spark, folder) as settings:
        return spark.read.parquet(settings.bad_records_path).select("raw_value", "missing")


@query("progress_after_replay")
def progress_after_replay(spark, folder):
    """Two batches, the first one replayed, and the progress rows merged: each batch counts once."""
    lake = Settings(lake_root=fresh_folder(spark, "lake"))
    store = AlertStore(spark, lake.alerts_path, run_id=1)
    on_batch = runner.JointBatch(runner.AlertBatch(with_rule_prediction, store, lake.progress_path), lake.archive_path,
                                 lake.bad_records_path, _as_of())
    records = cl.shape_record(replay_file_rows(transactions(spark, folder)))
    foreign = table(spark, folder, "events").select(F.col("props").alias("value"))
    arrived = F.current_timestamp().alias("timestamp")
    first = cl.to_messages(records.filter("hour_of_day < 12")).select("value", arrived)
    second = cl.to_messages(records.filter("hour_of_day >= 12")).select("value").union(foreign).select("value", arrived)
    for batch, number in ((first, 0), (second, 1), (first, 0)):
        on_batch(batch, number)
    runner.compact_progress(spark, lake.progress_path)
    counted = runner.read_progress(spark, lake.progress_path)
    return st.batch_progress(counted.select("batch_id", "n", "fraud", "alerts", "caught", "bad"))


@query("dedup_stream")
def dedup_stream(spark, folder):
    """Every message twice, the second time after a restart from the checkpoint: each is landed once."""
    landing, published, checkpoint = (fresh_folder(spark, n) for n in ("landing", "messages", "checkpoint"))
    sent = cl.to_messages(cl.shape_record(replay_file_rows(transactions(spark, folder)))).select("value")
    for part in (sent, sent):
        part.write.mode("append").text(published)
        unique = ql.drop_resent(ms.parse_messages(ms.file_stream(spark, published)).filter(~ql.is_bad()), lateness="90 days")
        writer = unique.writeStream.format("parquet").option("path", landing).option("checkpointLocation", checkpoint)
        runner.finish([writer.trigger(availableNow=True).start()])
    return spark.read.parquet(landing).select(*TRANSACTION_SCHEMA.names)


def _two_batches(spark: SparkSession, folder: str) -> AlertStore:
    """Alerts above 100 as batch 0; those above 250 again, with another amount, as batch 1."""
    store = AlertStore(spark, fresh_folder(spark, "alerts"), run_id=1)
    scored = with_rule_prediction(transactions(spark, folder))
    again = scored.filter("amount > 250").withColumn("amount", F.col("amount") * 2)
    store.write_batch(al.alert_projection(scored, _at(FIRST_BATCH_CLOCK)), 0)
    store.write_batch(al.alert_projection(again, _at(SECOND_BATCH_CLOCK)), 1)
    return store


@query("alert_upsert")
def alert_upsert(spark, folder):
    """Both batches, then batch 0 replayed under a later clock: batch 1 still wins."""
    store = _two_batches(spark, folder)
    scored = with_rule_prediction(transactions(spark, folder))
    store.write_batch(al.alert_projection(scored, _at(REPLAY_CLOCK)), 0)
    return store.read(_at(RETENTION_AS_OF)).select(*ALERT_COLUMNS)


@query("alert_retention")
def alert_retention(spark, folder):
    """Batch 0 has expired at the reading time unless batch 1 renewed the alert."""
    store = _two_batches(spark, folder)
    return store.read(_at(RETENTION_AS_OF)).select(*ALERT_COLUMNS)


@query("alerts_store_filtered")
def alerts_store_filtered(spark, folder):
    """Two merged batches, a third one in the log, and a filter that reaches the merged table."""
    store = _two_batches(spark, folder)
    store.compact()
    third = with_rule_prediction(transactions(spark, folder)).filter("amount > 400").withColumn("amount", F.col("amount") * 3)
    store.write_batch(al.alert_projection(third, _at(THIRD_BATCH_CLOCK)), 2)
    return al.list_alerts(store.read(_at(RETENTION_AS_OF)), category="travel")


@query("alert_purge_replay")
def alert_purge_replay(spark, folder):
    """Expired days go by name; batch 0 replayed before and after that never shows a row that batch 1 replaced."""
    store = _two_batches(spark, folder)
    scored = with_rule_prediction(transactions(spark, folder))
    for clock in (REPLAY_CLOCK, THIRD_BATCH_CLOCK):
        store.compact()
        store.write_batch(al.alert_projection(scored, _at(clock)), 0)
        store.compact()
        store.purge(LATE_PURGE)
    return store.read(F.lit(LATE_PURGE)).select(*ALERT_COLUMNS)


@query("dedup_transactions")
def dedup_transactions(spark, folder):
    """A replay that wraps around: everything is sent again, corrected above 100."""
    once = transactions(spark, folder).select("transaction_id", "transaction_time", "amount")
    corrected = (F.col("batch_id") == 1) & (F.col("amount") > 100)
    sent = once.withColumn("batch_id", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "amount", F.when(corrected, F.col("amount") * 1.5).otherwise(F.col("amount"))
    )
    return ql.latest_by_key(sent, "transaction_id", [F.desc("batch_id")])


@query("quarantine_bad")
def quarantine_bad(spark, folder):
    """Good records mixed with the events' own JSON, which lacks every transaction field."""
    good = cl.to_messages(cl.shape_record(replay_file_rows(transactions(spark, folder)))).select("value")
    foreign = table(spark, folder, "events").select(F.col("props").alias("value"))
    mixed = good.unionByName(foreign).withColumn("timestamp", F.current_timestamp())
    tagged = ql.with_missing(ms.parse_messages(mixed, keep_raw=True))
    return tagged.select(
        "transaction_id", F.when(F.col("missing") != "", F.col("raw_value")).alias("raw_value"), "missing"
    )


# -------------------------------------------------------------- model quality

@query("auc_roc")
def auc_roc(spark, folder):
    return mt.auc_roc(transactions(spark, folder), "amount")


@query("confusion_matrix")
def confusion_matrix(spark, folder):
    return mt.confusion_matrix(with_rule_prediction(transactions(spark, folder)))


@query("classification_metrics")
def classification_metrics(spark, folder):
    return mt.classification_metrics(with_rule_prediction(transactions(spark, folder)))


@query("threshold_sweep")
def threshold_sweep(spark, folder):
    scored = transactions(spark, folder).withColumn("score", F.col("amount") / 1000)
    return mt.threshold_sweep(scored, "score", SWEEP)


# ---------------------------------------------------------------- model training

@query("string_index")
def string_index(spark, folder):
    rows = transactions(spark, folder).select("transaction_id", "category")
    indexer = StringIndexer(inputCol="category", outputCol="category_idx", handleInvalid="keep")
    return indexer.fit(rows).transform(rows)


@query("assemble_skip")
def assemble_skip(spark, folder):
    rows = ft.with_features(transactions(spark, folder), _as_of())
    vectors = VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol="features", handleInvalid="skip")
    return vectors.transform(rows).select("transaction_id", "amount")


def _model_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ft.with_extended_features(transactions(spark, folder), _as_of())


def _train(spark: SparkSession, folder: str, recipe: tr.Recipe) -> PipelineModel:
    train, _ = sm.train_test(_model_rows(spark, folder))
    return tr.fit(recipe, train)


def _evaluated(spark: SparkSession, folder: str, recipe: tr.Recipe, model: PipelineModel) -> DataFrame:
    _, test = sm.train_test(_model_rows(spark, folder))
    return _rounded(tr.evaluate(model, recipe, test), "auc")


def _judged(spark: SparkSession, folder: str, recipes: tuple[tr.Recipe, ...]) -> DataFrame:
    """The evaluations of several recipes, as ``_evaluated`` gives them; the rows are joined and their features
    made once for all, in the columns that the recipes read."""
    columns = dict.fromkeys(("transaction_id", "is_fraud", *(c for r in recipes for c in (*r.numeric, *r.indexed))))
    with tr.written_rows(_model_rows(spark, folder).select(*columns), "model-rows") as rows:
        train, test = sm.train_test(rows)
        return tr.compare([_rounded(tr.evaluate(tr.fit(r, train), r, test), "auc") for r in recipes])


def _training_query(name: str, recipe: tr.Recipe) -> None:
    @query(name)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _evaluated(spark, folder, recipe, _train(spark, folder, recipe))


_training_query("train_dt", tr.DECISION_TREE)
_training_query("train_rf", tr.RANDOM_FOREST)
_training_query("train_rf_small", tr.RANDOM_FOREST_SMALL)
_training_query("train_gbt", tr.BOOSTED_TREES)


@query("train_rf_lean")
def train_rf_lean(spark, folder):
    """The lean forest; the category risk comes from the training rows only."""
    train, test = sm.train_test(_model_rows(spark, folder))
    risk, recipe = lk.category_risk(train), tr.RANDOM_FOREST_LEAN
    model = tr.fit(recipe, lk.with_category_risk(train, risk))
    return _rounded(tr.evaluate(model, recipe, lk.with_category_risk(test, risk)), "auc")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    model = _train(spark, folder, tr.RANDOM_FOREST_SMALL)
    return tr.score(model, tr.RANDOM_FOREST_SMALL, _model_rows(spark, folder))


@query("score_batch")
def score_batch(spark, folder):
    """Every transaction with what the model says about it."""
    return _scored(spark, folder).select("transaction_id", "amount", "is_fraud", "prediction", "fraud_probability")


@query("score_facts")
def score_facts(spark, folder):
    """What must hold of the scores whatever the model: rows with a score and positives among them, by category."""
    return _scored(spark, folder).filter("fraud_probability between 0 and 1 and prediction in (0, 1)").groupBy("category").agg(
        F.count("fraud_probability").alias("scored"), F.sum("is_fraud").alias("positives"))


SPLIT_FEATURES = ["amount", "hour_of_day", "city_pop", "lat", "unix_time"]


@query("split_search")
def split_search(spark, folder):
    """The best cut of each number by Gini impurity, over the training rows."""
    train, _ = sm.train_test(transactions(spark, folder))
    return _rounded(od.split_search(train, SPLIT_FEATURES, "is_fraud"), "gain")


@query("stump_metrics")
def stump_metrics(spark, folder):
    """The depth-one tree on the best of these cuts, judged on the test rows."""
    train, test = sm.train_test(transactions(spark, folder))
    splits = od.split_search(train, SPLIT_FEATURES, "is_fraud")
    return mt.classification_metrics(od.with_stump(test, splits))


@query("model_facts")
def model_facts(spark, folder):
    """What must hold of each model's evaluation: all test rows judged, positives and negatives as they are."""
    recipes = (tr.DECISION_TREE, tr.RANDOM_FOREST_SMALL)
    rows = _judged(spark, folder, recipes)
    return rows.filter("auc between 0 and 1").agg(
        F.count("*").alias("models"), F.min(F.col("tp") + F.col("fn")).alias("positives"), F.max(F.col("fp") + F.col("tn")).alias("negatives"))


@query("feature_importance")
def feature_importance(spark, folder):
    return tr.feature_importance(_train(spark, folder, tr.RANDOM_FOREST_SMALL), tr.RANDOM_FOREST_SMALL)


@query("model_comparison")
def model_comparison(spark, folder):
    recipes = (tr.DECISION_TREE, tr.RANDOM_FOREST_SMALL, tr.BOOSTED_TREES)
    return _judged(spark, folder, recipes)


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """Save, load and score: how many rows the loaded model scores differently."""
    recipe, path = tr.DECISION_TREE, fresh_folder(spark, "model")
    model = _train(spark, folder, recipe)
    tr.save_model(model, path)
    rows = _model_rows(spark, folder)
    before = tr.score(model, recipe, rows).withColumnRenamed("fraud_probability", "before")
    after = tr.score(runner.load_model(path), recipe, before.drop("prediction"))
    return after.agg(
        F.count("*").alias("scored"),
        F.count_if(F.col("before") != F.col("fraud_probability")).alias("differing"),
    )

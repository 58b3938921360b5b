"""Command line: ``python -m riskstream.jobs <job> ...`` or the same through spark-submit."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.config import Settings
from riskstream.operators.alerts import display_alerts, list_alerts
from riskstream.operators.columns import (
    drop_index_column, normalize_columns, replay_order, shape_record, to_messages,
)
from riskstream.operators.features import extend_features, with_extended_features
from riskstream.operators.lookup import category_risk, with_category_risk
from riskstream.operators.sampling import hash_sample, train_test
from riskstream.operators.stats import alert_stats_maps, dataset_profile, stats_document
from riskstream.plans import training as tr
from riskstream.session import build_session
from riskstream.sinks import files
from riskstream.sinks.alert_store import AlertStore
from riskstream.sources import messages, tables
from riskstream.streaming import runner

def _as_of(args) -> Column | None:
    return F.lit(args.as_of).cast("date") if args.as_of else None


def _table(spark: SparkSession, path: str, csv: bool) -> DataFrame:
    rows = tables.read_training_csv(spark, path) if csv else spark.read.parquet(path)
    return drop_index_column(rows)


def _scorer(spark: SparkSession, args) -> runner.Scorer | None:
    """The saved model as a function of a batch, with the category risk that was saved beside it if its
    recipe needs one; None without a model."""
    model = runner.load_model(args.model) if args.model else None
    if model is None:
        return None
    recipe = tr.RECIPES[args.recipe]
    risk = spark.read.parquet(tr.risk_path(args.model)) if recipe.needs_risk else None

    def score(batch: DataFrame) -> DataFrame:
        rows = extend_features(batch)
        return tr.score(model, recipe, rows if risk is None else with_category_risk(rows, risk), args.threshold)

    return score


def train(spark: SparkSession, settings: Settings, args) -> DataFrame:
    """Fit a recipe on 80 % of a table, save it, and report how it does on the rest."""
    rows = normalize_columns(_table(spark, args.input, args.csv))
    if args.sample < 1.0:
        rows = hash_sample(rows, args.sample)
    training, test = train_test(with_extended_features(rows, _as_of(args)))
    recipe = tr.RECIPES[args.recipe]
    if recipe.needs_risk:  # of the training rows only
        category_risk(training).write.mode("overwrite").parquet(tr.risk_path(args.model))
        risk = spark.read.parquet(tr.risk_path(args.model))
        training, test = with_category_risk(training, risk), with_category_risk(test, risk)
    model = tr.fit(recipe, training, args.balance)
    tr.save_model(model, args.model)
    return tr.evaluate(model, recipe, test)


def stream(spark: SparkSession, settings: Settings, args) -> None:
    """Archive, quarantine and alert on messages from Kafka or, with --folder, from files."""
    if args.folder:
        source = messages.file_stream(spark, args.folder, settings.max_files_per_trigger)
    else:
        source = messages.kafka_stream(spark, settings)
    start = runner.start_joint if args.joint else runner.start_all
    queries = start(spark, source, settings, _scorer(spark, args), _as_of(args))
    if args.until_empty:
        runner.finish(queries)
    else:
        runner.run_until_stopped(spark, queries)


def publish(spark: SparkSession, settings: Settings, args) -> DataFrame:
    """Send a replay file as keyed messages, in random order; returns its profile."""
    rows = _table(spark, args.input, args.csv)
    sent = to_messages(shape_record(replay_order(rows, "trans_num")))
    if args.folder:
        files.publish_to_files(sent, args.folder)
    else:
        files.publish_to_kafka(sent, settings)
    return dataset_profile(rows)


def convert(spark: SparkSession, settings: Settings, args) -> None:
    """A Parquet copy of a CSV table."""
    files.csv_to_parquet(spark, args.input, args.output)


def stats(spark: SparkSession, settings: Settings, args) -> DataFrame:
    """The statistics object of the current alerts as one JSON text."""
    store = AlertStore(spark, settings.alerts_path)
    return stats_document(alert_stats_maps(store.read(retention_days=settings.retention_days)))


def alerts(spark: SparkSession, settings: Settings, args) -> DataFrame:
    """The current alerts, filtered and limited, under their display labels."""
    current = AlertStore(spark, settings.alerts_path).read(retention_days=settings.retention_days)
    return display_alerts(list_alerts(current, args.limit, args.category, args.state, args.limit_first))


def maintain(spark: SparkSession, settings: Settings, args) -> DataFrame:
    """Merge finished alert batches into the table of current alerts and delete its expired days; merge the
    progress rows and, with --compact-day, the archive files of a finished day."""
    store = AlertStore(spark, settings.alerts_path)
    merged = store.compact(keep_newest=True, grace=dt.timedelta(minutes=args.grace_minutes))
    expired = store.purge(dt.datetime.now(), settings.retention_days)
    runner.compact_progress(spark, settings.progress_path)
    if args.compact_day:
        files.compact_archive_day(spark, settings.archive_path, dt.date.fromisoformat(args.compact_day))
    return spark.createDataFrame([(merged, expired)], "merged_batches int, expired_days int")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="riskstream")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, *, table: bool = False, model: bool = False) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=globals()[name].__doc__)
        if table:
            job.add_argument("--input", required=True)
            job.add_argument("--csv", action="store_true", help="the input is CSV, not Parquet")
        if model:
            job.add_argument("--recipe", choices=sorted(tr.RECIPES), default=tr.BOOSTED_TREES.name)
            job.add_argument("--model", required=name == "train")
            job.add_argument("--as-of", help="reference day for ages, today if absent")
        return job

    job = add("train", table=True, model=True)
    job.add_argument("--sample", type=float, default=1.0)
    job.add_argument("--balance", action="store_true", help="weight the rare class up")
    job = add("stream", model=True)
    job.add_argument("--folder", help="read JSON lines from here instead of Kafka")
    job.add_argument("--threshold", type=float)
    job.add_argument("--joint", action="store_true", help="parse once, in one query for all sinks")
    job.add_argument("--until-empty", action="store_true", help="stop when the source is drained")
    add("publish", table=True).add_argument("--folder", help="write JSON lines here instead of to Kafka")
    add("convert", table=True).add_argument("--output", required=True)
    add("stats")
    job = add("maintain")
    job.add_argument("--compact-day", help="YYYY-MM-DD")
    job.add_argument("--grace-minutes", type=int, default=60, help="keep merged batches this long for running readers")
    job = add("alerts")
    job.add_argument("--limit", type=lambda text: None if text == "all" else int(text), default=1000, help="a number, or all")
    job.add_argument("--limit-first", action="store_true", help="cut before filtering, as the published endpoint does")
    job.add_argument("--category")
    job.add_argument("--state")
    return parser


def _show_all(rows: DataFrame) -> None:
    """Every row as a line of tab-separated text, partition by partition, so that the driver holds one at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join(map(str, row)))


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    settings = Settings.from_env()
    spark = build_session(f"riskstream-{args.job}", settings)
    result = globals()[args.job](spark, settings, args)
    if result is not None:
        if getattr(args, "limit", 1000) is None:
            _show_all(result)
        else:
            result.show(getattr(args, "limit", 1000), truncate=False)  # all that was asked for


if __name__ == "__main__":
    main(sys.argv[1:])

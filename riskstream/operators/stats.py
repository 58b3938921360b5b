"""Aggregates over alerts and transactions. Each is one partial/final hash aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _known_state() -> Column:
    return F.col("state").isNotNull() & (F.col("state") != "")


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("count"))


def _finite_amount() -> Column:
    """Null for an amount that is missing, NaN or infinite."""
    return F.when(F.abs("amount") < float("inf"), F.col("amount"))


def alert_stats(alerts: DataFrame) -> DataFrame:
    """One row, zeros for an empty table; rows without a finite amount count but do not add."""
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.round(F.coalesce(F.sum(_finite_amount()), F.lit(0.0)), 2).alias("total_amount"),
        F.round(F.coalesce(F.avg(_finite_amount()), F.lit(0.0)), 2).alias("avg_amount"),
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def alerts_by_category(alerts: DataFrame) -> DataFrame:
    """A missing category is a group of its own."""
    return count_by(alerts, "category")


def alerts_by_state(alerts: DataFrame) -> DataFrame:
    """Missing and empty states are left out."""
    return count_by(alerts.filter(_known_state()), "state")


def alert_stats_maps(alerts: DataFrame) -> DataFrame:
    """The full statistics object: totals plus counts per category and per state as maps.

    The rows are read once into (category, state) cells; grouping sets over those cells give
    the three levels, and only one entry per category or state reaches the final row.
    """
    named = F.coalesce("category", F.lit("null")).alias("category")  # one map key with the text "null"
    cells = alerts.groupBy(named, "state").agg(
        F.count("*").alias("n"), F.count(_finite_amount()).alias("priced"), F.sum(_finite_amount()).alias("amount")
    )
    category, state = F.col("category"), F.col("state")
    levels = cells.groupingSets([[category], [state], []], category, state).agg(
        F.grouping_id().alias("level"), F.sum("n").alias("n"),
        F.sum("priced").alias("priced"), F.sum("amount").alias("amount"),
    )
    # grouping_id has a bit per absent column: category level 0b01, state level 0b10, total 0b11.
    per_category = F.when(
        F.col("level") == 1, F.struct(F.col("category").alias("k"), F.col("n").alias("v"))
    )
    per_state = F.when(
        (F.col("level") == 2) & _known_state(), F.struct(F.col("state").alias("k"), F.col("n").alias("v"))
    )

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("level") == 3, F.col(name)))

    def as_map(entries: Column) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(entries)))

    return levels.agg(
        F.coalesce(total("n"), F.lit(0)).alias("total_alerts"),
        F.round(F.coalesce(total("amount"), F.lit(0.0)), 2).alias("total_amount"),
        F.round(F.coalesce(total("amount") / F.nullif(total("priced"), F.lit(0)), F.lit(0.0)), 2)
        .alias("avg_amount"),
        as_map(per_category).alias("by_category"),
        as_map(per_state).alias("by_state"),
    )


def stats_document(maps: DataFrame) -> DataFrame:
    """The statistics row as one JSON text."""
    return maps.select(F.to_json(F.struct("*")).alias("stats"))


def distinct_categories(alerts: DataFrame) -> DataFrame:
    return alerts.select("category").distinct()


def categories_ranked(alerts: DataFrame) -> DataFrame:
    return alerts_by_category(alerts).orderBy(F.desc("n"), F.asc("category"))


def top_states(alerts: DataFrame, k: int = 10) -> DataFrame:
    return alerts_by_state(alerts).orderBy(F.desc("n"), F.asc("state")).limit(k)


def dataset_profile(transactions: DataFrame) -> DataFrame:
    fraud = F.coalesce(F.sum("is_fraud"), F.lit(0))
    return transactions.agg(
        F.count("*").alias("n"),
        fraud.alias("fraud"),
        F.round(F.avg("is_fraud"), 6).alias("fraud_rate"),
        (F.count("*") - fraud).alias("normal"),
    )


def round_width(spread: Column, bins: int) -> Column:
    """The smallest of 1, 2 and 5 times a power of ten that is at least a ``bins``-th of ``spread``; 1 for none."""
    least = spread / bins
    power = F.pow(F.lit(10.0), F.floor(F.log10(least)))
    steps = [F.when(power * m >= least, power * m) for m in (1, 2, 5)]
    return F.when(least > 0, F.coalesce(*steps, power * 10)).otherwise(1.0)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, bin_start, bin_end, n): bins of a round width, ``bins`` + 1 at most, empty ones included.

    Bins begin at multiples of their width, the first holds the smallest value and is number 0. Missing
    and non-finite values have no bin; without any value there are no bins. The bounds are one scalar
    subquery; nothing but the counts is joined and no value reaches the driver.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(F.abs("x") < float("inf"))
    bounds = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = round_width(hi - lo, bins)
    counted = values.groupBy(F.floor(F.col("x") / width).alias("at")).agg(F.count("*").alias("n"))
    first, last = F.floor(lo / width), F.floor(hi / width)
    every = df.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("at"))
    return every.join(counted, "at", "left").select(
        (F.col("at") - first).cast("int").alias("bin"),
        (F.col("at") * width).alias("bin_start"),
        ((F.col("at") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def with_running_totals(df: DataFrame, order: str, columns: list[str], span: int = 10_000) -> DataFrame:
    """Adds ``cum_<column>`` in order of an integer column, without a one-task window.

    Rows are cut into spans of the order column. Windows run inside a span; the totals of the
    earlier spans, one row per span, are added on top.
    """
    # A missing order value sorts first, so its rows form the lowest span.
    cut = df.withColumn("_span", F.coalesce(F.floor(F.col(order) / span), F.lit(-(2**62))))
    spans = cut.groupBy("_span").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        "_span", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in columns]
    )
    inside = Window.partitionBy("_span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = cut.withColumns({f"_r_{c}": F.sum(c).over(inside) for c in columns})
    return running.join(offsets, "_span").withColumns(
        {f"cum_{c}": F.col(f"_r_{c}") + F.col(f"_o_{c}") for c in columns}
    ).drop("_span", *[f"_{p}_{c}" for p in "ro" for c in columns])


def batch_counts() -> dict[str, Column]:
    """Aggregates of a scored batch: rows, labelled positives, alerts and caught positives."""
    positive, alert = F.col("is_fraud") == 1, F.col("prediction") == 1

    def count_if(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    return {"n": F.count(F.lit(1)), "fraud": count_if(positive), "alerts": count_if(alert), "caught": count_if(positive & alert)}


def batch_metrics(scored: DataFrame, key: str = "batch_id") -> DataFrame:
    """``batch_counts`` per batch."""
    return scored.groupBy(key).agg(*[c.alias(name) for name, c in batch_counts().items()])


def batch_progress(per_batch: DataFrame, order: str = "batch_id") -> DataFrame:
    """Running totals and the running share of positives, batch by batch."""
    running = with_running_totals(per_batch, order, ["n", "fraud", "alerts", "caught"])
    share = F.col("cum_fraud") / F.nullif(F.col("cum_n"), F.lit(0)) * 100
    return running.withColumn("cum_fraud_pct", F.round(share, 4))

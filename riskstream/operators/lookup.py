"""Joins against small derived tables, left to the optimizer, which broadcasts by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_risk(training: DataFrame, label: str = "is_fraud", smoothing: float = 100.0) -> DataFrame:
    """Smoothed positive rate per lower-cased category: (positives + m * prior) / (rows + m).

    ``prior`` is the overall rate. Nothing runs or is kept while the plan is built; the counts,
    one row per category, are one exchange, which Spark reuses for the prior and the rates.
    """
    counts = training.groupBy(F.lower("category").alias("category_key")).agg(
        F.count(label).alias("n"), F.sum(F.col(label).cast("long")).alias("positives")
    )
    prior = counts.agg(
        F.coalesce(F.sum("positives") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0))
    ).scalar()
    rate = (F.coalesce("positives", F.lit(0)) + prior * smoothing) / (F.col("n") + smoothing)
    return counts.filter("category_key is not null").select(
        "category_key", rate.alias("category_risk_score"), prior.alias("risk_prior")
    )


def with_category_risk(df: DataFrame, risk: DataFrame) -> DataFrame:
    """Attach ``category_risk_score`` (the prior for unseen categories) and risk x amount."""
    prior = risk.agg(F.coalesce(F.max("risk_prior"), F.lit(0.0))).scalar()
    keyed = df.withColumn("category_key", F.lower("category"))
    joined = keyed.join(risk, "category_key", "left")
    score = F.coalesce("category_risk_score", prior)
    return joined.drop("category_key", "risk_prior").withColumns(
        {"category_risk_score": score, "risk_amount_interaction": score * F.col("amount")}
    )

"""Alert rows and the queries served from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import format_amount
from riskstream.schema import (
    ALERT_COPIED_COLUMNS, ALERT_DISPLAY_LABELS, ALERT_LATEST_COLUMNS, ALERT_LIMIT_RANGE,
    ALERT_SERVED_COLUMNS,
)


def newest_first() -> list[Column]:
    """A total order, so a limit always returns the same rows."""
    return [F.desc("detected_at"), F.desc("transaction_time"), F.asc("transaction_id")]


def alert_projection(scored: DataFrame, detected_at: Column | None = None,
                     extra: tuple[str, ...] = ()) -> DataFrame:
    """Positive predictions as alert rows; ``detected_at`` is the clock unless given.

    ``extra`` names further columns of ``scored`` to carry along.
    """
    clock = F.current_timestamp() if detected_at is None else detected_at
    return scored.filter(F.col("prediction") == 1).select(
        *ALERT_COPIED_COLUMNS,
        F.col("prediction").alias("is_fraud"),
        clock.alias("detected_at"),
        *extra,
    )


def newest(alerts: DataFrame, n: int) -> DataFrame:
    """The n newest alerts, in order.

    One plan for every n: Spark's top-n, in which each task sends its n newest rows at most.
    ``ALERT_LIMIT_RANGE`` bounds n.
    """
    return alerts.orderBy(*newest_first()).limit(n)


def list_alerts(alerts: DataFrame, limit: int | None = None, category: str | None = None,
                state: str | None = None, limit_first: bool = False) -> DataFrame:
    """Served alert rows, newest first.

    ``limit_first`` cuts before it filters, as the published endpoint does, so a filtered call
    can return fewer rows than asked for. The default filters first, which also lets the
    filters reach the scan.
    """
    low, high = ALERT_LIMIT_RANGE
    if limit is not None and not low <= limit <= high:
        raise ValueError(f"limit must be within {low} and {high}, got {limit}")
    wanted = {name: value for name, value in (("category", category), ("state", state)) if value}

    def filtered(df: DataFrame) -> DataFrame:
        for name, value in wanted.items():
            df = df.filter(F.col(name) == value)
        return df

    served = alerts.select(*ALERT_SERVED_COLUMNS)
    if limit is None:
        return filtered(served)
    if limit_first:
        return filtered(newest(served, limit))
    return newest(filtered(served), limit)


def latest_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The short listing: five columns of the n newest alerts."""
    return newest(alerts, n).select(*ALERT_LATEST_COLUMNS)


def display_alerts(alerts: DataFrame) -> DataFrame:
    """Nine columns under their display labels, with typed times and formatted amounts."""
    shown = {
        "transaction_time": F.col("transaction_time").cast("timestamp"),
        "amount": format_amount(F.col("amount")),
    }
    return alerts.select(
        *[shown.get(name, F.col(name)).alias(label) for name, label in ALERT_DISPLAY_LABELS.items()]
    )

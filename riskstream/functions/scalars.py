"""Column expressions. Every function takes and returns a Column and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskstream.schema import EARTH_RADIUS_KM


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def zip_pad(zip_code: Column, width: int = 5) -> Column:
    """Left-pad with zeros; longer codes stay as they are (``lpad`` alone would cut them)."""
    return F.when(F.length(zip_code) < width, F.lpad(zip_code, width, "0")).otherwise(zip_code)


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 without zone; the fraction is written only when there is one."""
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def mask_card(card: Column) -> Column:
    """Last four digits followed by a mask; ``N/A`` for a missing or empty number."""
    return F.when(F.length(card) > 0, F.concat(F.right(card, F.lit(4)), F.lit("****"))).otherwise(
        F.lit("N/A")
    )


def format_amount(amount: Column) -> Column:
    """Dollar display with thousands separators and two decimals."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def full_years(birth: Column, as_of: Column) -> Column:
    """Completed years from ``birth`` (text, date or timestamp) to ``as_of``; null if unreadable."""
    months = F.months_between(as_of, birth.try_cast("date"))
    return F.floor(months / 12)


def great_circle_km(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Haversine distance. The clamp keeps rounding from pushing ``asin`` out of its domain."""
    def half_sine_squared(delta: Column) -> Column:
        s = F.sin(F.radians(delta) / 2)
        return s * s

    parallels = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    h = half_sine_squared(lat2 - lat1) + parallels * half_sine_squared(long2 - long1)
    # least() skips nulls, so the clamp must leave null and NaN alone.
    clamped = F.when((h > 1.0) & ~F.isnan(h), F.lit(1.0)).otherwise(h)
    return F.asin(F.sqrt(clamped)) * (2 * EARTH_RADIUS_KM)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """The ratio where the denominator is positive, else 0.0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def hash_position(key: Column, seed: int) -> Column:
    """Eight hex digits, uniform in the key, independent of partitioning and of the engine."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 8)


def hash_below(key: Column, seed: int, fraction: float) -> Column:
    """True for about ``fraction`` of the keys, always the same ones for one seed."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be within 0 and 1, got {fraction}")
    if fraction == 1.0:
        return F.lit(True)
    return hash_position(key, seed) < F.lit(f"{int(fraction * 16**8):08x}")

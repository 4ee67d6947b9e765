"""Column expressions shared by every operator.

All of them are built-in Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen. Times are zone-less UTC wall-clock values
(``TimestampNTZType`` from the driver parquet, ``TimestampType`` under a UTC
session zone for landed JSON); only ``timestampdiff``/``timestampadd`` and
date functions are used on them, which accept both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Default cap (minutes) credited to one online interval.
DEFAULT_CAP_MINUTES = 15
# Base vocations, in the order the dashboard tests and lists them.
BASE_VOCATIONS = ["Monk", "Knight", "Paladin", "Druid", "Sorcerer"]
UNKNOWN_VOCATION = "Unknown"
# Level bands: (exclusive upper bound, label); anything else is "500+".
LEVEL_BANDS = [
    (50, "001-049"),
    (100, "050-099"),
    (150, "100-149"),
    (200, "150-199"),
    (300, "200-299"),
    (500, "300-499"),
]
LEVEL_BAND_ELSE = "500+"
# Status value meaning "online" (compared lower-cased, null = offline).
ONLINE_STATUS = "online"
# Market: freshness window and history-day clamp.
MARKET_FRESH_HOURS = 6
MARKET_MAX_HISTORY_DAYS = 10000
# Queue: failure back-off and stale-claim timeout, minutes.
QUEUE_FAILURE_BACKOFF_MINUTES = 30
QUEUE_STALE_MINUTES = 15
QUEUE_ERROR_MAX_CHARS = 1000
QUEUE_ERROR_PREVIEW_CHARS = 200
# Retention windows.
RETENTION_DAYS = 7
RETENTION_LEGACY_MONTHS = 3

_MICROS_PER_MINUTE = 60_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a, b) -> Column:
    """Integral division (SQL ``div``): exact on longs, no double rounding."""
    return F.call_function("div", col(a), b if isinstance(b, Column) else F.lit(b))


def micros_between(start, end) -> Column:
    """Exact microseconds from ``start`` to ``end`` (NTZ or LTZ timestamps)."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def interval_minutes(start, end) -> Column:
    """Whole minutes between two times, rounded half away from zero, floor 0.

    Integer arithmetic on microseconds: no floating point, so it agrees
    exactly with a decimal ``round(epoch_seconds / 60)``.
    """
    micros = micros_between(start, end)
    half = _MICROS_PER_MINUTE // 2
    rounded = F.when(micros >= 0, idiv(micros + half, _MICROS_PER_MINUTE)) \
        .otherwise(-idiv(-micros + half, _MICROS_PER_MINUTE))
    return F.greatest(rounded, F.lit(0)).cast("int")


def capped_minutes(minutes, cap: int = DEFAULT_CAP_MINUTES) -> Column:
    return F.least(col(minutes), F.lit(int(cap))).cast("int")


def is_online(status) -> Column:
    """Case-insensitive online test; null status is offline."""
    return F.lower(F.coalesce(col(status), F.lit(""))) == F.lit(ONLINE_STATUS)


def base_vocation(vocation) -> Column:
    """Ordered substring test, first match wins; else ``Unknown``."""
    lowered = F.lower(F.coalesce(col(vocation), F.lit("")))
    expr = None
    for name in BASE_VOCATIONS:
        cond = lowered.contains(name.lower())
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN_VOCATION))


def level_band(level) -> Column:
    """Band label; a null level falls to the ELSE branch (``500+``)."""
    expr = None
    for upper, label in LEVEL_BANDS:
        cond = col(level) < upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(LEVEL_BAND_ELSE))


def null_safe_differs(a, b) -> Column:
    """``a IS DISTINCT FROM b``."""
    return ~col(a).eqNullSafe(col(b))


def round_ratio(numerator, denominator, scale: int) -> Column:
    """round(numerator / denominator, scale), half away from zero, exact.

    Pure integer arithmetic on the two (integral) operands, then one exact
    decimal shift: no intermediate rounding at any scale. Null when the
    denominator is 0 or null.
    """
    factor = 10 ** scale
    n = col(numerator).cast("bigint")
    d = F.nullif(col(denominator).cast("bigint"), F.lit(0))
    q = idiv(F.abs(n) * (2 * factor) + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    shifted = signed.cast("decimal(30,0)") / F.lit(factor)
    return shifted.cast(f"decimal(20,{scale})")


def exact_avg(values_sum, values_count, scale: int) -> Column:
    return round_ratio(values_sum, values_count, scale)


def js_round_percent(part, total) -> Column:
    """JavaScript ``Math.round(100 * part / total)`` for non-negative ints."""
    return F.when(col(total) > 0,
                  idiv(col(part) * 200 + col(total), col(total) * 2).cast("int"))


def spread(buy, sell) -> Column:
    return (col(sell) - col(buy)).cast("bigint")


def spread_pct(buy, sell) -> Column:
    """round((sell - buy) / nullif(buy, 0) * 100, 2); zero buy gives null."""
    return round_ratio((col(sell) - col(buy)) * F.lit(100), col(buy), 2)


def parse_joined_date(value) -> Column:
    """ISO date or ``Mon DD YYYY``; anything else is null."""
    v = F.trim(col(value))
    return F.coalesce(
        F.try_to_date(v, "yyyy-MM-dd"),
        F.try_to_date(v, "MMM d yyyy"),
    )


def unix_seconds_to_ts(seconds) -> Column:
    """Fractional unix seconds to a UTC timestamp at millisecond precision."""
    millis = F.floor(col(seconds) * 1000).cast("bigint")
    return F.timestamp_millis(millis).cast("timestamp_ntz")


def history_days(start_date, as_of) -> Column:
    """Days of history needed from ``start_date`` to ``as_of``: ceil, 1..10000."""
    micros = micros_between(F.to_timestamp(col(start_date)).cast("timestamp_ntz"), col(as_of))
    per_day = 86_400_000_000
    days = F.when(micros < 0, F.lit(1)).otherwise(
        idiv(micros + per_day - 1, per_day))
    return F.least(F.greatest(days, F.lit(1)), F.lit(MARKET_MAX_HISTORY_DAYS)).cast("int")


def slug(name) -> Column:
    """File-name slug of an entity name: lower case, spaces to '_'."""
    return F.replace(F.lower(col(name)), F.lit(" "), F.lit("_"))


def nonempty(c) -> Column:
    """Empty string becomes null (script truthiness)."""
    return F.nullif(col(c), F.lit(""))

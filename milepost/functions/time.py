"""Instant / duration expressions.  Durations are double hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros_between(a, b) -> Column:
    """Exact microseconds b - a."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b))


def hours_between(a, b) -> Column:
    """Signed exact hours b - a at microsecond resolution (SECOND truncates)."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b)).cast("double") / F.lit(3.6e9)


def round_hours_from_micros(micros) -> Column:
    """round(micros / 3.6e9, 3), half away from zero, in exact integer arithmetic
    so every engine agrees on ties."""
    s = _c(micros).cast("bigint")
    mag = F.floor((F.abs(s) * 2 + 3_600_000) / 7_200_000)
    return (F.signum(s) * mag).cast("double") / F.lit(1000.0)


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", _c(seconds), _c(ts))


def add_hours(ts, hours) -> Column:
    """ts + fractional hours, to the microsecond."""
    micros = F.round(_c(hours) * F.lit(3.6e9)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


def iso_instant(ts) -> Column:
    """ISO-8601 UTC with a Z suffix; sub-seconds truncated."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")

"""Scalar column expressions of the domain (all JVM-side built-ins).

Each function returns a ``Column``; none triggers a job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightlake.schemas import CRITICAL_STOP_STATUSES, SURROGATE_NULL, VALID_STATUSES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, scale: int = 2) -> Column:
    """Round half away from zero on the decimal value, return a double.

    Rounds ``cast(x as decimal(38,10))`` so that the result does not depend on
    the binary representation of the double (1.005 -> 1.01 everywhere).
    """
    return F.round(_c(col).try_cast("decimal(38,10)"), scale).cast("double")


def status_norm(col) -> Column:
    """upper(trim(status)) with each run of whitespace replaced by ``_``."""
    return F.regexp_replace(F.upper(F.trim(_c(col))), r"\s+", "_")


def to_ts(col) -> Column:
    """Timestamp from a timestamp or text column; malformed text -> NULL (ANSI-safe)."""
    return F.try_to_timestamp(_c(col))


def to_day(col) -> Column:
    """Date from a timestamp, date or text column; malformed text -> NULL (ANSI-safe)."""
    return F.try_to_date(_c(col))


def duration_minutes(start, end) -> Column:
    """Whole-second difference in minutes as a double; NULL if an end is
    NULL or not a timestamp (raw text drops may carry malformed values)."""
    return (F.unix_timestamp(to_ts(end)) - F.unix_timestamp(to_ts(start))) / F.lit(60)


def sla_violated(duration, sla_hours, default_sla_hours: float | None = None) -> Column:
    """P3 (+P18): duration > sla*60, strictly; NULL on either side -> False."""
    sla = _c(sla_hours)
    if default_sla_hours is not None:
        sla = F.coalesce(sla, F.lit(default_sla_hours))
    return F.when(_c(duration) > sla * F.lit(60), F.lit(True)).otherwise(F.lit(False))


def surrogate_key(*cols) -> Column:
    """MD5 text key over the columns, NULL-safe, ``-`` separated."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws("-", *parts)
    return F.md5(joined)


def unknown_member(col, default: int = -1) -> Column:
    """Dimension key or the unknown-member key."""
    return F.coalesce(_c(col), F.lit(default))


def duration_hours(duration) -> Column:
    """P10: hours rounded to 2 places for durations of an hour or more, else NULL."""
    d = _c(duration)
    return F.when(d >= 60, round_half_up(d / F.lit(60.0), 2))


def pct_sla_used(duration, sla_hours) -> Column:
    """Share of the SLA used, in percent, when the SLA is positive."""
    s = _c(sla_hours)
    return F.when(s > 0, round_half_up(_c(duration) / (s * F.lit(60)) * F.lit(100), 2))


def critical_stop(status, duration, minutes: int = 120) -> Column:
    """Stopped or in maintenance for more than ``minutes``; NULL -> False."""
    cond = _c(status).isin(CRITICAL_STOP_STATUSES) & (_c(duration) > minutes)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def lookback(col, as_of: _dt.date | str, days: int) -> Column:
    """``col >= as_of - days`` with ``as_of`` a parameter, not the clock."""
    return _c(col) >= F.date_sub(F.lit(str(as_of)).cast("date"), days)


def invalid_status(col) -> Column:
    """NOT IN the valid statuses; a NULL status is neither valid nor invalid."""
    return ~_c(col).isin(VALID_STATUSES)


def mask_hash(col) -> Column:
    """Irreversible SHA-256 of the text value."""
    return F.sha2(_c(col).cast("string"), 256)


def mask_text(col) -> Column:
    """Letters and digits replaced by X / x / n, other characters kept."""
    return F.mask(_c(col).cast("string"))


def ts_literal(value) -> Column:
    """A fixed instant as a TIMESTAMP literal (the run clock is a parameter)."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")

"""Calendar expressions used by the cohort report and the wire decoders.

All conversions between wire integers and timestamps go through
``timestampadd`` / ``timestampdiff`` on ``timestamp_ntz`` values, which do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_EPOCH_DATE = "DATE'1970-01-01'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_trunc(c) -> Column:
    """DATE_TRUNC('month', ts) as a timestamp_ntz (month start, midnight)."""
    return F.trunc(_c(c).cast("date"), "MM").cast("timestamp_ntz")


def add_months(c, months: int) -> Column:
    """``ts + INTERVAL 'n months'`` (end-of-month clamped, like PostgreSQL)."""
    return _c(c) + F.expr(f"INTERVAL {int(months)} MONTHS")


def months_between_starts(cohort_month, month) -> Column:
    """Whole months from one month start to another: (year, month) arithmetic, no time zone involved."""
    c, m = _c(cohort_month), _c(month)
    return (F.year(m) - F.year(c)) * 12 + (F.month(m) - F.month(c))


def period_num(activity_month, cohort_month) -> Column:
    """EXTRACT(MONTH FROM AGE(activity_month, cohort_month)) for month starts.

    AGE's month field is the whole-month difference modulo 12 (sign kept), so a
    return after 12 months maps to 0 exactly as the reference computes it.
    """
    diff = months_between_starts(cohort_month, activity_month)
    return (diff % F.lit(12)).cast("int")


def epoch_millis(c) -> Column:
    """timestamp_ntz -> milliseconds since 1970-01-01 (wire form of a timestamp)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(c).cast("timestamp_ntz"))


def from_epoch_millis(c) -> Column:
    """Milliseconds since the epoch -> timestamp_ntz; outside years 1..9999 gives NULL (rejected later)."""
    ms = _c(c).cast("bigint")
    ok = ms.between(-62135596800000, 253402300799999)
    return F.when(ok, F.timestamp_add("MILLISECOND", F.when(ok, ms).otherwise(F.lit(0)), F.expr(_EPOCH_NTZ)))


def epoch_days(c) -> Column:
    """date -> days since 1970-01-01 (wire form of a date)."""
    return F.date_diff(_c(c).cast("date"), F.expr(_EPOCH_DATE))


def from_epoch_days(c) -> Column:
    """Days since the epoch -> date; outside 0001..9999 gives NULL (rejected later)."""
    d = _c(c).cast("bigint")
    ok = d.between(-719162, 2932896)
    return F.when(ok, F.date_add(F.expr(_EPOCH_DATE), d.cast("int")))

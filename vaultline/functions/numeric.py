"""Exact decimal rounding for ratios.

Percentages and per-customer averages are exact ratios rounded half away
from zero (PostgreSQL NUMERIC ``ROUND``).  Computing them through a double
division rounds some half-way cases the wrong way, and a long decimal
division rounds once at its own result scale before ``round`` rounds again;
integer arithmetic on the scaled numerator is exact for any size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    """Amount as DECIMAL(18,2), the vault's money type."""
    return _c(c).cast("decimal(18,2)")


def round_div(num, den, digits: int = 2, num_scale: int = 0) -> Column:
    """round(num / den, digits), half away from zero, exact; NULL if den is 0 or NULL.

    ``num`` is integral, or a decimal with ``num_scale`` fractional digits
    (e.g. a money sum with ``num_scale=2``).  Returns DOUBLE: the double
    nearest to the exact decimal result.
    """
    if digits < num_scale:
        raise ValueError("digits must be >= num_scale")
    n = (_c(num) * F.lit(10 ** num_scale)).cast("decimal(38,0)") * F.lit(10 ** (digits - num_scale))
    n = n.cast("decimal(38,0)")
    d = F.nullif(_c(den).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    twice_n = (F.abs(n) * 2 + F.abs(d)).cast("decimal(38,0)")
    twice_d = (F.abs(d) * 2).cast("decimal(38,0)")
    # floor(twice_n / twice_d) without any rounding step: subtract the remainder first
    q = ((twice_n - twice_n % twice_d) / twice_d).cast("decimal(38,0)")
    # sign by comparison: F.signum returns DOUBLE and would turn the product into floating point
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q).cast("decimal(38,0)")
    exact = (signed / F.lit(10 ** digits).cast("decimal(38,0)")).cast(f"decimal(38,{digits})")
    # decimal text -> double is correctly rounded at any magnitude; a double
    # division of the integer would round twice above 2**53 units
    return exact.cast("string").cast("double")


def pct(part, whole, digits: int = 2) -> Column:
    """ROUND(part::DECIMAL / whole * 100, 2) as DOUBLE, exact half away from zero."""
    return round_div(_c(part).cast("decimal(38,0)") * 100, whole, digits)

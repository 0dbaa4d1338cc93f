"""Numeric helpers: exact money rounding, null-safe ratios, clamps, row means.

Money stays DECIMAL so sums do not depend on partitioning.  A mean that must
be written back into a money column is rounded half-up at the column's scale
with integer arithmetic, so the value is the same on every engine and plan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_units(c, scale: int) -> Column:
    """Exact integer count of 10^-scale units of a DECIMAL value (decimal(38,0))."""
    return (_c(c) * F.lit(10**scale)).cast("decimal(38,0)")


def half_up_div(num, den) -> Column:
    """round_half_up(num / den) for integral num and positive integral den, exact (LONG)."""
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    mag = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -mag).otherwise(mag)


def from_units(units, scale: int, precision: int = 18) -> Column:
    """DECIMAL(precision, scale) from an integer count of 10^-scale units."""
    step = F.lit(Decimal(1).scaleb(-scale))
    return (_c(units).cast("decimal(38,0)") * step).cast(f"decimal({precision},{scale})")


def ratio(num, den) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def clamp(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def row_mean(cols) -> Column:
    """Null-skipping mean across columns of one row (pandas ``mean(axis=1)``)."""
    cols = [_c(c) for c in cols]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((c.isNotNull().cast("double") for c in cols), F.lit(0.0))
    return F.try_divide(total, count)


def safe_corr(x, y) -> Column:
    """Pearson correlation as ``covar_pop / (stddev_pop·stddev_pop)``; NULL for a constant column.

    Plain ``corr`` raises under ANSI when a side is constant, even behind a CASE.
    """
    return F.try_divide(F.covar_pop(_c(x), _c(y)), F.stddev_pop(_c(x)) * F.stddev_pop(_c(y)))

"""Exact arithmetic helpers.

The reports round ratios and averages.  Computing those in floating point and
rounding afterwards makes the last digit depend on summation order and on how
an engine rounds a binary fraction such as 1.005.  These helpers keep the
computation in integers and decimals and only produce a DOUBLE at the very
end, so the value is the exact half-away-from-zero rounding of the true ratio.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled_half_up(num: ColumnOrName, den: ColumnOrName, digits: int) -> Column:
    """``round(num / den * 10**digits)`` half away from zero, as an exact BIGINT.

    ``num`` and ``den`` are integral; ``den <= 0`` or NULL gives NULL (a division
    by zero is NULL, as in the reference dialect).
    """
    n = _col(num).cast("decimal(38,0)")
    d = _col(den).cast("decimal(38,0)")
    twice = F.when(d > 0, d * 2).cast("decimal(38,0)")
    scale = F.lit(10**digits).cast("decimal(38,0)")
    q = (F.abs(n) * scale * 2 + d).cast("decimal(38,0)")
    # without its remainder q divides evenly, so the decimal division has nothing to round
    mag = ((q - q % twice).cast("decimal(38,0)") / twice).cast("long")
    return F.signum(n).cast("long") * mag


def unscale(scaled: ColumnOrName, digits: int) -> Column:
    """An integer holding a value times ``10**digits`` as the nearest DOUBLE of that value."""
    return (_col(scaled).cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(
        f"decimal(38,{digits})"
    ).cast("double")


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 2, *, times: int = 1) -> Column:
    """``ROUND(num * times / den, digits)`` computed exactly; DOUBLE, NULL when ``den`` is 0."""
    return unscale(scaled_half_up(_col(num).cast("decimal(38,0)") * times, den, digits), digits)


def dialect_avg(total: ColumnOrName, count: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(AVG(int_col), digits)`` as the reference dialect evaluates it.

    There ``AVG`` of an integer column is a decimal with four fractional digits
    (already rounded), and ``ROUND`` then rounds that decimal again.  Both steps
    are reproduced on the exact sum and count.
    """
    four = scaled_half_up(total, count, 4)
    if digits >= 4:
        return unscale(four, 4)
    return unscale(scaled_half_up(four, F.lit(10 ** (4 - digits)), 0), digits)


def greatest_strict(*cols: ColumnOrName) -> Column:
    """``GREATEST`` that returns NULL when any argument is NULL (Spark's skips NULLs)."""
    cs = [_col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cs))


def money(col: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """A money column as ``DECIMAL(precision, scale)`` so sums are exact."""
    return _col(col).cast(f"decimal({precision},{scale})")


def money_sum(col: ColumnOrName) -> Column:
    """Exact sum of a money column, typed ``DECIMAL(38,2)``."""
    return F.sum(money(col)).cast("decimal(38,2)")

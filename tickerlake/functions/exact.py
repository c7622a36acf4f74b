"""Exact decimal arithmetic for ratios whose rounded value drives labels.

Category thresholds read *rounded* percentages, so a last-digit error moves a
row to another label. Spark's decimal division rounds its quotient to a scale
chosen from the operand types (as low as 6 places), and rounding that result
again to 2 places can differ from rounding the true quotient. These helpers
therefore do one exact integral division (``div``) on decimals: the result is
the true quotient rounded HALF_UP (away from zero), for any magnitude. Every
expression stays a JVM-side Catalyst expression (whole-stage codegen).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_half_up(num, den, scale: int, factor: int = 1, precision: int = 28,
                  operand_scale: int | None = None) -> Column:
    """``round(num * factor / den, scale)`` with HALF_UP rounding, exactly.

    NULL when ``den`` is NULL or zero (as ``try_divide``). ``num`` and ``den``
    must be exact types (integral or decimal).

    With ``operand_scale`` (the decimal places of both operands) rows whose
    operands fit in 64 bits take an integer path: the unscaled values are read
    through DOUBLE (exact with margin below 2^49) and divided as longs. Larger values
    fall back to the same division on DECIMAL. Both paths give identical results;
    the integer one avoids per-row BigDecimal arithmetic.
    """
    num, den = _col(num), _col(den)
    k = factor * 10 ** scale
    out_type = T.DecimalType(precision, scale)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(1)

    def signed(mag: Column) -> Column:
        return F.when((num < 0) != (den < 0), -mag).otherwise(mag)

    mag = F.call_function("div", F.abs(num) * F.lit(2 * k) + F.abs(den), F.abs(den) * F.lit(2))
    exact = (signed(mag).cast(T.DecimalType(precision - scale, 0)) * unit).cast(out_type)
    if operand_scale is None:
        return F.when(den != 0, exact)

    m = 10 ** operand_scale
    limit = min(2 ** 49, (2 ** 63 - 1) // (2 * k + 2))
    nd, dd = num.cast("double") * m, den.cast("double") * m
    small = (F.abs(nd) < limit) & (F.abs(dd) < limit)
    n, d = F.rint(nd).cast("bigint"), F.rint(dd).cast("bigint")
    fast_mag = F.call_function("div", F.abs(n) * F.lit(2 * k) + F.abs(d), F.abs(d) * F.lit(2))
    fast = (signed(fast_mag).cast(T.DecimalType(18, 0)) * unit).cast(out_type)
    return F.when(den != 0, F.when(small, fast).otherwise(exact))


def pct_half_up(num, den, scale: int = 2, operand_scale: int | None = None) -> Column:
    """``round(num / den * 100, scale)``, exact; NULL when ``den`` is 0.

    Pass ``operand_scale=2`` where both operands are 2-place prices: the same
    result by 64-bit integers.
    """
    return ratio_half_up(num, den, scale, factor=100, operand_scale=operand_scale)


def as_decimal(col, precision: int = 20, scale: int = 0) -> Column:
    return _col(col).cast(T.DecimalType(precision, scale))

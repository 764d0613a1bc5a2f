"""Exact rounding helpers.

Postgres computes ratios and money in NUMERIC and rounds half away from zero.
Doubles round differently in each engine near ties, so every rounded ratio and
every amount of money here is computed on integers (counts, cents, basis
points) with an explicit half-away-from-zero integral division, and converted
to double or decimal only in the last projection.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CENT = Decimal("0.01")


def idiv(a: Column, b: Column | int) -> Column:
    """SQL ``a div b``: integral division truncating toward zero (bigint)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def round_half_up_div(num: Column, den: Column | int) -> Column:
    """``round(num / den)`` half away from zero, on integers; NULL if den = 0.

    Both operands must be integral; ``den`` may be negative.
    """
    if not isinstance(den, Column):
        # Constant divisor (the common case): (2n + sign(n)*d) div 2d, with div
        # truncating toward zero -- one division, small generated code.
        if den == 0:
            return F.lit(None).cast("bigint")
        d = abs(den)
        q = idiv(num * 2 + F.when(num >= 0, F.lit(d)).otherwise(F.lit(-d)), 2 * d)
        return (q if den > 0 else -q).cast("bigint")
    den_c = den
    q = idiv(F.abs(num) * 2 + F.abs(den_c), F.abs(den_c) * 2)
    negative = (num < 0) != (den_c < 0)
    return F.when(den_c != 0, F.when(negative, -q).otherwise(q).cast("bigint"))


def ratio_units(num: Column, den: Column, scale: int) -> Column:
    """``round(num/den, scale)`` in units of 10**-scale (bigint), half away from zero."""
    return round_half_up_div(num.cast("bigint") * (10 ** scale), den.cast("bigint"))


def ratio(num: Column, den: Column, scale: int) -> Column:
    """``ROUND(num::NUMERIC / den, scale)`` returned as double (NULL if den = 0)."""
    return ratio_units(num, den, scale).cast("double") / F.lit(float(10 ** scale))


def cents(amount: Column) -> Column:
    """Money amount -> integer cents (exact for decimals of scale <= 2; nearest
    cent for doubles)."""
    return F.round(amount * 100, 0).cast("bigint")


def from_cents(c: Column, precision: int = 14) -> Column:
    """Integer cents -> decimal(precision, 2) dollars, exactly."""
    return (c.cast("decimal(20,0)") * F.lit(CENT)).cast(f"decimal({precision},2)")


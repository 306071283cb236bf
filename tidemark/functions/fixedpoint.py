"""Order-independent money and percentage arithmetic.

A sum of doubles depends on the order in which partitions arrive. Every sum here runs
over integers (millionths of an amount, cents of a rounded figure, hundredths) and becomes
a double again in one division at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(value: Column, digits: int) -> Column:
    """``value * 10^digits`` as BIGINT, nearest integer, halves up."""
    return F.floor(value.cast("double") * F.lit(float(10**digits)) + F.lit(0.5))


def cents(amount: Column) -> Column:
    return scaled(amount, 2)


def micros(amount: Column) -> Column:
    """Millionths, for sums: an amount may be smaller than a cent, and only its sum is rounded."""
    return scaled(amount, 6)


def whole_cents(total: Column) -> Column:
    """Cents, halves up, of a sum in millionths."""
    return F.floor((total.cast("decimal(30,0)") + 5000) / 10000).cast("bigint")


def from_cents(amount: Column) -> Column:
    return amount.cast("double") / F.lit(100.0)


_LOW_BITS = 32


def halves(value: Column) -> tuple[Column, Column]:
    """``value`` (BIGINT) as high * 2^32 + low. Sums of either fit a BIGINT for 2^31 rows, whatever the values."""
    wide = value.cast("bigint")
    return F.shiftright(wide, _LOW_BITS), wide.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))


def joined_halves(high: Column, low: Column) -> Column:
    """The DECIMAL(30,0) of two sums over :func:`halves`."""
    unit = F.lit(1 << _LOW_BITS).cast("decimal(10,0)")
    return (high.cast("decimal(20,0)") * unit + low.cast("decimal(20,0)")).cast("decimal(30,0)")


def wide_sum(value: Column) -> Column:
    """Sum of integers that stays exact beyond BIGINT, added up in two longs: decimals are objects, made anew for every row."""
    high, low = halves(value)
    return joined_halves(F.sum(high), F.sum(low))


def round_half_up(value: Column, digits: int) -> Column:
    unit = F.lit(float(10**digits))
    return F.floor(value * unit + F.lit(0.5)) / unit


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half up; NULL when the denominator is 0."""
    unit = F.lit(float(10**digits))
    divisor = F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.floor(numerator.cast("double") * unit / divisor + F.lit(0.5)) / unit


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded double quotient; NULL when the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))

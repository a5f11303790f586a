"""Exact sums, ratios and shares.

A sum of doubles depends on the order in which tasks finish, and a sum of decimals costs
ten times as much per row. So each amount is taken apart without loss: whole hundredths,
summed in two machine words, a high and a low part, and what the double says beyond them, which
only amounts with more than two decimals have, as a decimal of fifteen places. The
three sums together are exact and do not depend on any order.

One rule holds for all amounts: what is not finite, or so large that doubles skip whole units
(2**53 and more), is no amount. It counts as null in sums, counts and means.

Ratios are taken between decimals and rounded half up before they become doubles,
so a share such as 16.665 % always rounds the same way.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from marquee import schemas

_COUNT = "decimal(20,0)"
_LOW_BITS = 20
#: From here on doubles do not tell whole units apart.
AMOUNT_LIMIT = float(2**53)
_EXACT = "decimal(31,15)"
_REST = "decimal(25,15)"
_CENT = Decimal("0.01")
#: One digit less than a sum, so that adding two keeps all places.
_PART = "decimal(37,15)"
_SHARED = "decimal(24,2)"


def usable(amount: Column) -> Column:
    """The amount, or null for one that is not finite or beyond the limit (NaN compares as the largest)."""
    return F.when(F.abs(amount) < AMOUNT_LIMIT, amount)


def hundredths(amount: Column) -> Column:
    return F.rint(usable(amount) * 100).cast("long")


def high_part(amount: Column) -> Column:
    return F.shiftright(hundredths(amount), _LOW_BITS)


def low_part(amount: Column) -> Column:
    return hundredths(amount).bitwiseAND(F.lit((1 << _LOW_BITS) - 1))


def rest_part(amount: Column) -> Column:
    """What an amount has beyond its hundredths; null for the usual ones, which are the nearest doubles to hundredths."""
    whole = hundredths(amount)
    beyond = usable(amount).cast(_EXACT) - whole.cast(_COUNT) * F.lit(_CENT)
    return F.when(whole / F.lit(100.0) != amount, beyond.cast(_REST))


def joined(high: Column, low: Column, rest: Column) -> Column:
    """The amount behind summed parts, as a decimal; null when there was no amount."""
    whole = high.cast(_COUNT) * (1 << _LOW_BITS) + low.cast(_COUNT)
    return (whole * F.lit(_CENT)).cast(_PART) + F.coalesce(rest, F.lit(0)).cast(_PART)


def exact_sum(amount: Column) -> Column:
    """Sum of an amount over a group, as a decimal; null when no row has one."""
    return joined(F.sum(high_part(amount)), F.sum(low_part(amount)), F.sum(rest_part(amount)))


def rounded(value: Column, digits: int = 0) -> Column:
    return F.round(value, digits).cast("double")


def ratio(part: Column, count: Column, digits: int = 0) -> Column:
    """Amount per count; null when the count is zero."""
    return rounded(F.try_divide(part, count.cast(_COUNT)), digits)


def share(part: Column, digits: int = 2, scale: int = 100) -> Column:
    """Part of the sum over all rows, times ``scale``.

    For frames that are already aggregated: the window has no partition key. Where the
    whole is small, both are multiplied alike, so that fractions of a hundredth count.
    """
    exact = part.cast(schemas.AMOUNT_SUM)
    whole = F.sum(exact).over(Window.partitionBy()).cast(schemas.AMOUNT_SUM)
    small = F.abs(whole) < 1_000_000

    def even(value: Column) -> Column:
        large = (value.cast("decimal(24,15)") * F.lit(Decimal(10**10))).cast(_SHARED)
        return F.when(small, large).otherwise(value.cast(_SHARED))

    return rounded(F.try_divide(even(exact) * scale, even(whole)), digits)


def millions(value: Column) -> Column:
    return value / F.lit(1e6)

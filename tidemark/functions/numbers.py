"""Ratios and the fixed-point texts used in messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRACTION_BITS = 56


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; NULL where the quotient is undefined."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def two_places(value: Column) -> Column:
    """``value`` with two decimals, rounding the binary value half to even.

    This is what C and Python print. ``format_string('%.2f')`` rounds the
    shortest decimal text half up instead, so 3.125 and 1.015 come out
    differently. The fraction is scaled by a power of two, which loses nothing,
    and rounded as an integer.
    Valid for magnitudes below 2**53.
    """
    one = 1 << FRACTION_BITS
    size = F.abs(value)
    whole = F.floor(size)
    scaled = (size - whole) * float(one)
    bits = F.floor(scaled)
    product = bits * 100
    cents = F.shiftright(product, FRACTION_BITS)
    rest = product.bitwiseAND(F.lit(one - 1))
    over_half = (rest - one // 2).cast("double") + (scaled - bits) * 100
    up = (over_half > 0) | ((over_half == 0) & (cents % 2 == 1))
    total = whole * 100 + cents + up.cast("bigint")
    text = F.concat(
        ((total - total % 100) / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((total % 100).cast("string"), 2, "0"),
    )
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)

"""Rounding of the binary value itself, ties to even, as Python's ``round`` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF_BITS = float(1 << 26)


def round_exact(value: Column, digits: int) -> Column:
    """``value`` rounded to ``digits`` decimals (up to six).

    Built-in rounding looks at the shortest decimal form, where 69.195 is a tie, while its binary
    value lies below. The fraction is split into two halves of 26 bits, so their multiples
    of ten are exact and the comparison with one half is too.
    """
    scale = 10 ** digits
    size = F.abs(value)
    whole = F.floor(size)
    fraction = size - whole
    upper = F.floor(fraction * F.lit(_HALF_BITS)) / F.lit(_HALF_BITS)
    lower = (fraction - upper) * F.lit(scale)
    units = F.floor(upper * F.lit(scale))
    to_half = F.lit(0.5) - (upper * F.lit(scale) - units)
    count = whole * F.lit(scale) + units
    up = (lower > to_half) | ((lower == to_half) & (count % 2 != 0))
    rounded = (count + F.when(up, 1).otherwise(0)) / F.lit(float(scale))
    return F.when(value < 0, -rounded).otherwise(rounded)

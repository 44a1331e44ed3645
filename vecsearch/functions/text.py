"""Text formatting of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int) -> Column:
    """A non-negative number (null stays null) with ``digits`` decimals, rounded on its exact binary value, ties to even.

    The JVM formatter rounds the shortest decimal text half up, which differs for numbers whose
    text ends exactly in a half (0.125 or 0.075 with two decimals). For those the true side is
    found without rounding error: the number is split in two short parts whose products are exact.
    """
    scale = float(2 * 10 ** digits)
    half = F.rint(x * scale)
    on_half = (F.pmod(half, F.lit(2.0)) == 1.0) & (x == half / scale)
    high = x.cast("float").cast("double")
    below = (half - high * scale) - (x - high) * scale
    even_down = F.pmod(half - 1, F.lit(4.0)) == 0.0
    down = (below > 0) | ((below == 0) & even_down)
    nearest = F.when(on_half, F.when(down, half - 1).otherwise(half + 1) / scale).otherwise(x)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", nearest))

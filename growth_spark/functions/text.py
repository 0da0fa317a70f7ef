"""Numbers as texts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_places(x: Column) -> Column:
    """A double rounded to hundredths (halves of the binary value away from zero) and written as SQL's cast to text does: with one
    decimal at least, without an exponent below 1e16, the sign of a negative zero kept. Null stays null."""
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), "-").otherwise("")
    cents = F.abs(x) * 100
    whole = F.floor(cents)
    # From 2**52 on a double has no fraction; floor() would pass 64 bits.
    size = F.when(cents >= 2.0**52, F.abs(x)).otherwise((whole + F.when(cents - whole >= 0.5, 1).otherwise(0)).cast("double") / 100)
    plain = F.regexp_replace(size.cast("decimal(20,2)").cast("string"), "0$", "")
    large = F.regexp_replace(F.regexp_replace(size.cast("string"), r"\.0E", "E"), "E", "e+")
    return F.when(F.isnan(x), "nan").when(F.abs(x) == math.inf, F.concat(sign, F.lit("inf"))).otherwise(F.concat(sign, F.when(size < 1e16, plain).otherwise(large)))

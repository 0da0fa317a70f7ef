"""Means of doubles that are the same for any order and partitioning of the rows.

A sum of doubles depends on the order of its terms. Here each finite value is cut into whole multiples of powers of two,
``BITS`` bits a part, which is without error; sums of parts are sums of integers, so partial sums may meet in any order. One group's sum is put together and
divided as an integer, so equal sums of as many values give equal doubles.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import EACH, crowded, dealt

#: Bits of a part: 2**39 rows can be summed before a sum of parts passes 64 bits.
BITS = 24
#: Exponent of the smallest positive double.
LEAST = -1074


def exponents(df: DataFrame, *values: str) -> list[int]:
    """Exponents of the parts, highest first, that together hold every finite value of these columns without error: one pass
    for the greatest and the smallest magnitude."""
    sizes = [F.abs(F.col(v).cast("double")) for v in values or ("value",)]
    known = [F.when(~F.isnan(s) & (s < math.inf) & (s > 0), s) for s in sizes]
    ends = df.agg(*(f(k) for k in known for f in (F.max, F.min))).first()
    there = [x for x in ends if x is not None]
    high, low = max(there, default=None), min(there, default=None)
    if high is None:
        return [0]
    top, last = math.frexp(high)[1], max(math.frexp(low)[1] - 53, LEAST)
    parts = max(-(-(top - last) // BITS), 1)
    return [max(top - BITS * (k + 1), LEAST) for k in range(parts)]


def _parts(value: Column, exps: list[int]) -> list[Column]:
    size, sign = F.abs(value), F.signum(value).cast("bigint")
    out = []
    for k, e in enumerate(exps):
        rest = size if k == 0 else size % F.lit(math.ldexp(1.0, exps[k - 1]))  # the remainder of doubles is exact
        out.append(sign * F.floor(rest / F.lit(math.ldexp(1.0, e))).cast("bigint"))
    return out


def _quotient(exps: list[int], summed: bool = False):
    """Function of columns (n, parts' sums): the double nearest to their sum divided by ``n``. Integers divide exactly rounded,
    so the mean of equal values is that value, however many they are. With ``summed`` the sum is made a double before."""
    unit = exps[-1]
    shifts = [e - unit for e in exps]

    def nearest(n: int, parts: tuple) -> float:
        total = sum(int(p) << s for p, s in zip(parts, shifts, strict=True))
        try:
            if summed:
                return (total / (1 << -unit) if unit < 0 else float(total << unit)) / n
            return total / (n << -unit) if unit < 0 else (total << unit) / n
        except OverflowError:
            return math.copysign(math.inf, total)

    @F.pandas_udf("double")
    def divided(n: pd.Series, *parts: pd.Series) -> pd.Series:
        return pd.Series([nearest(int(k), p) if k else math.nan for k, *p in zip(n, *parts, strict=True)], dtype="float64")

    return divided


def sums(value: str, exps: list[int], name: str) -> list[Column]:
    """Aggregates that ``mean`` of the same name reads; nulls don't count."""
    x = F.col(value).cast("double")
    odd = F.isnan(x) | (F.abs(x) == math.inf)
    parts = [F.sum(p).alias(f"{name}_part{k}") for k, p in enumerate(_parts(F.when(~odd, x), exps))]
    return [*parts, F.sum(F.when(odd, x)).alias(f"{name}_odd"), F.count(x).alias(f"{name}_n")]


def mean(exps: list[int], name: str, summed: bool = False) -> Column:
    """The mean from ``sums``: null where all are null, NaN or infinite where the plain sum is. With ``summed`` it is rounded twice,
    as engines do that sum doubles and then divide: the sum, then the quotient."""
    quotient = _quotient(exps, summed)(f"{name}_n", *(F.coalesce(f"{name}_part{k}", F.lit(0).cast("bigint")) for k in range(len(exps))))
    return F.when(F.col(f"{name}_n") > 0, F.coalesce(f"{name}_odd", quotient))


def means(df: DataFrame, keys: list[str], exps: list[int], value: str = "value", rows: int = 0, most: int = 0, by: tuple[str, ...] = (), apart: list[str] | None = None, each: int = EACH) -> DataFrame:
    """(keys, value): the mean of each group's values, from one aggregation with partial sums.

    ``exps`` come from ``exponents`` of ``df`` or of rows that hold its values.

    Where ``rows``, about their number, are more than ``each`` a partition of the session's, they are dealt out to more
    partitions before they are summed, by those of the keys that ``apart`` names or by all. ``most`` is a number of rows that no
    group passes: if it is more than ``each``, groups are summed in shares first, which columns ``by`` tell apart, so that no
    group is dealt out whole to one task.
    """
    summed = sums(value, exps, "_x")
    if crowded(df.sparkSession, rows, each):
        df = df.select(*keys, value, *by)
        if most > each:
            share = [*keys, "_share"]
            shares = df.withColumn("_share", F.pmod(F.xxhash64(*by), F.lit(-(-most // each))))
            df = dealt(shares, share, rows, each).groupBy(*share).agg(*summed)
            summed = [F.sum(c).alias(c) for c in df.columns if c not in share]
        df = dealt(df, apart or keys, rows, each)
    return df.groupBy(*keys).agg(*summed).select(*keys, mean(exps, "_x").alias(value))


def rounded(x: Column, places: int) -> Column:
    """A double rounded as SQL engines do: scaled, halves of the scaled double away from zero, scaled back. Spark's own rounding
    judges the shortest decimal that stands for the double, which near a half may be another."""
    scale = float(10**places)
    size = F.abs(x) * scale
    whole = F.floor(size)
    near = F.signum(x) * (whole + F.when(size - whole >= 0.5, 1).otherwise(0)).cast("double") / scale
    # From 2**52 on a double has no fraction; so have those that are no number.
    return F.when(size < 2.0**52, near).otherwise(x)

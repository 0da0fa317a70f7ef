"""Ordered work on groups of any size: cuts in time, and exact medians by narrowing.

A window by item sorts an item in one task. Where an item has more than ``MOST`` rows, its rows are cut into blocks of
time; blocks are worked on in parallel, and only a summary row a block is ordered by item.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut

#: Rows of a group that one task sorts.
MOST = 1 << 20
#: Buckets of a round of narrowing.
BUCKETS = 1024


def largest(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group, and the number of groups: one row from counts that are partial before the shuffle."""
    found = df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n"), F.count("*")).first()
    return found[0] or 0, found[1]


def cuts(df: DataFrame, keys: list[str], time: str, most: int = MOST, known: int | None = None) -> list[float]:
    """Times between blocks of about ``most`` rows of the groups that have more; none where no group has. ``known`` is the
    number of rows of the largest group, where the caller has it."""
    if (largest(df, keys)[0] if known is None else known) <= most:
        return []
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = sizes.filter(F.col("_n") > most)
    total = large.agg(F.sum("_n")).first()[0]
    same = [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys]
    rows = df.join(large.select(*(F.col(k).alias(f"_own_{k}") for k in keys)), same, "left_semi").select(F.col(time).cast("double").alias("_t"))
    parts = -(-total // most)
    return sorted(set(rows.approxQuantile("_t", [i / parts for i in range(1, parts)], 0.2 / parts)))


def in_blocks(df: DataFrame, time: str, at: list[float]) -> DataFrame:
    """``df`` with the number of its block of time in ``_block``; rows of one time are in one block."""
    bucket = Bucketizer(splits=[float("-inf"), *at, float("inf")], inputCol="_t", outputCol="_bucket", handleInvalid="keep")
    return bucket.transform(df.withColumn("_t", F.col(time).cast("double"))).withColumn("_block", F.col("_bucket").cast("int")).drop("_t", "_bucket")


def _picked(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The mean of the two middle values of groups with their number of values ``_n`` and of those below, ``_before``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(value)) + F.col("_before")
    middle = rows.withColumn("_k", place).filter((F.col("_k") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_k") == F.floor(F.col("_n") / 2) + 1))
    return middle.groupBy(*keys).agg(F.min(value).alias("_a"), F.max(value).alias("_b")).select(*keys, ((F.col("_a") + F.col("_b")) / 2).cast("double").alias("m"))


def medians(df: DataFrame, keys: list[str], value: str, most: int = MOST, known: int | None = None) -> DataFrame:
    """(keys, m): the exact median of each group's non-null values, of all values where ``keys`` are none. ``known`` is a number
    of rows that no group passes, where the caller has one; if it is small, sorting is all there is to do.

    Groups of up to ``most`` values are sorted. Of larger ones the interval that holds the middle is narrowed in rounds: counts
    by bucket (partial before the shuffle) tell the bucket of the middle, and its least and greatest value bound the next
    round, until at most ``most`` values or a single one is left. So no task gets more of a group than that.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    if known is not None and known <= most:
        counted = rows.withColumns({"_n": F.count("*").over(Window.partitionBy(*keys)), "_before": F.lit(0).cast("bigint")})
        return _picked(counted, keys, value).filter("m IS NOT NULL")
    rows = cut(rows, "values")
    bounds = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi")).filter("_n > 0")
    bounds = cut(bounds.withColumns({"_before": F.lit(0).cast("bigint"), "_left": F.col("_n")}), "bounds")
    open_ = (F.col("_left") > most) & (F.col("_lo") < F.col("_hi"))

    def inside(b: DataFrame) -> DataFrame:
        if not keys:
            return rows.join(F.broadcast(b)).filter(F.col(value).between(F.col("_lo"), F.col("_hi")))  # one row
        own = b.select(*(F.col(k).alias(f"_own_{k}") for k in keys), *(c for c in b.columns if c not in keys))
        same = [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys]
        return rows.join(own, same).filter(F.col(value).between(F.col("_lo"), F.col("_hi"))).drop(*(f"_own_{k}" for k in keys))

    while not bounds.filter(open_).isEmpty():
        span = F.col("_hi").cast("double") - F.col("_lo").cast("double")
        bucket = F.least(F.floor((F.col(value).cast("double") - F.col("_lo").cast("double")) / span * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        counted = inside(bounds.filter(open_)).groupBy(*keys, "_n", "_before", bucket.alias("_bucket")).agg(F.count("*").alias("_c"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_bucket")) + F.col("_before")  # at most BUCKETS rows a group
        held = counted.withColumn("_upto", upto).filter((F.col("_upto") >= F.floor((F.col("_n") + 1) / 2)) & (F.col("_upto") - F.col("_c") < F.floor(F.col("_n") / 2) + 1))
        narrowed = held.groupBy(*keys, "_n").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.min(F.col("_upto") - F.col("_c")).alias("_before"), F.sum("_c").alias("_left"))
        bounds = cut(bounds.filter(~open_).unionByName(narrowed.select(bounds.columns)), "bounds")
    single = bounds.filter("_lo = _hi").select(*keys, F.col("_lo").cast("double").alias("m"))
    return single.unionByName(_picked(inside(bounds.filter("_lo < _hi")), keys, value).filter("m IS NOT NULL"))

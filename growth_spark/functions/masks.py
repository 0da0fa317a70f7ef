"""Masks as rows of half-open runs in column-major order: (…, start, end, mask_height, mask_width)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import EACH, dealt


def runs_of(df: DataFrame, keys: list[str], counts: str = "mask_rle") -> DataFrame:
    """Runs of set pixels from alternating run lengths (unset first). Null and empty masks have none."""
    rows = df.filter(F.size(counts) > 0).withColumn("_mask", F.monotonically_increasing_id()).select(*keys, "_mask", "mask_height", "mask_width", F.posexplode(counts).alias("_i", "_n"))
    until = Window.partitionBy(*keys, "_mask").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    ended = rows.withColumn("end", F.sum(F.col("_n").cast("bigint")).over(until))
    return ended.filter((F.col("_i") % 2 == 1) & (F.col("_n") > 0)).select(*keys, (F.col("end") - F.col("_n")).alias("start"), "end", "mask_height", "mask_width")


def union(runs: DataFrame, keys: list[str], rows: int | None = None, each: int = EACH) -> DataFrame:
    """Logical or of all runs with the same keys: overlapping and touching ones become one. A task sorts about ``each`` runs;
    ``rows`` is about their number, where the caller has it."""
    runs = dealt(runs, keys, runs.count() if rows is None else rows, each)
    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    islands = runs.withColumn("_new", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
    islands = islands.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("mask_height").alias("mask_height"), F.first("mask_width").alias("mask_width")).drop("_island")


def reflect(runs: DataFrame, keys: list[str], origin: str, each: int = EACH) -> DataFrame:
    """Runs mirrored about the column ``origin``; columns that would fall outside the mask are left out."""
    h = F.col("mask_height").cast("bigint")
    columns = runs.withColumn("_c", F.explode(F.sequence(F.floor(F.col("start") / h), F.floor((F.col("end") - 1) / h))))
    # One piece a column, its rows unchanged.
    top = F.greatest(F.col("start"), F.col("_c") * h) - F.col("_c") * h
    bottom = F.least(F.col("end"), (F.col("_c") + 1) * h) - F.col("_c") * h
    pieces = columns.withColumns({"_to": 2 * F.col(origin).cast("bigint") - F.col("_c"), "_top": top, "_bottom": bottom}).filter((F.col("_to") >= 0) & (F.col("_to") < F.col("mask_width")))
    moved = pieces.withColumns({"start": F.col("_to") * h + F.col("_top"), "end": F.col("_to") * h + F.col("_bottom")})
    # A run lies in one column or two as a rule; counting the runs themselves is the cheaper pass.
    return union(moved.select(*keys, "start", "end", "mask_height", "mask_width"), keys, 2 * runs.count(), each)

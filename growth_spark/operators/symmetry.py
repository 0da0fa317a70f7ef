"""Symmetrised patterns: nodes mirrored about each image's reflection plane and merged where boxes overlap."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import exact
from ..functions.geometry import mirrored, mirrored_edge
from ..plans.tables import EACH, cut, dealt
from . import settling
from .pattern import FEW, edges, overlapping

# How merged nodes are summed up.
MEANS = ("centroid_0", "centroid_1", "intensity_centroid_0", "intensity_centroid_1", "relative_centroid_0", "relative_centroid_1", "relative_intensity_centroid_0", "relative_intensity_centroid_1", "bbox_minc", "bbox_minr", "bbox_maxc", "bbox_maxr", "area", "specular_origin_0", "specular_origin_1", "center_distance", "fwhm_0", "fwhm_1", "eccentricity", "axis_major_length", "axis_minor_length", "bbox_intensity", "spot_area", "streak_area", "roughness_metric", "distances")
FIRSTS = ("pattern_id", "mask_width", "mask_height")
BOX = ("bbox_minr", "bbox_minc", "bbox_maxr", "bbox_maxc")
EXACT = (*BOX, "centroid_0", "centroid_1")
#: Passes after which a pattern that still changes is an error.
MOST_PASSES = 50
#: Nodes of an image up to which one task merges the image as it is.
WHOLE = 512


def _columns(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in names if c in df.columns]


def _united(runs: Column) -> Column:
    """Runs of several masks as the runs of their union."""
    last = lambda t: F.element_at(t, -1)
    joined = lambda t, x: F.when((F.size(t) > 0) & (last(t)["end"] >= x["start"]), F.concat(F.slice(t, 1, F.size(t) - 1), F.array(F.struct(last(t)["start"].alias("start"), F.greatest(last(t)["end"], x["end"]).alias("end"))))).otherwise(F.concat(t, F.array(x)))
    return F.aggregate(F.array_sort(runs), F.array().cast("array<struct<start:bigint,end:bigint>>"), joined)


def _summed(df: DataFrame, keys: list[str], exps: list[int], seq: str = "seq") -> DataFrame:
    """Means, firsts and united masks of each group. Sums of boxes and centres are exact before they are rounded, since boxes are
    compared afterwards and centres are told by many digits: so the order of the rows changes neither."""
    firsts = [F.min_by(c, seq).alias(c) for c in _columns(df, FIRSTS)]
    masks = [_united(F.flatten(F.collect_list("runs"))).alias("runs")] if "runs" in df.columns else []
    own = [] if "node_id" in keys else [F.min("node_id").alias("node_id")]
    sums = [x for c in EXACT for x in exact.sums(c, exps, f"_{c}")]
    plain = [F.avg(c).alias(c) for c in _columns(df, MEANS) if c not in EXACT]
    grouped = df.groupBy(*keys).agg(*plain, *sums, *own, *firsts, *masks, *([F.min(seq).alias("seq")] if seq not in keys else []))
    return grouped.select(*(c for c in grouped.columns if not any(c.startswith(f"_{b}_") for b in EXACT)), *(exact.mean(exps, f"_{c}", summed=True).alias(c) for c in EXACT))


def merge_pass(nodes: DataFrame, few: int = FEW) -> DataFrame:
    """Each node becomes the sum of all whose boxes it overlaps; equal smallest ids then become one; ids above 1000 are
    numbered on from the largest below, the largest first. Pairs are found by boxes alone; the rest of a node follows them."""
    exps = exact.exponents(nodes, *EXACT)
    pairs = overlapping(nodes.select("data_id", "seq", *[F.col(c).alias(c[5:]) for c in BOX]), 4, few)
    met = pairs.withColumnsRenamed({"a": "at", "b": "seq"}).join(nodes, ["data_id", "seq"])
    first = _summed(met, ["data_id", "at"], exps).drop("seq").withColumnRenamed("at", "seq")
    # Means of means have more digits below, but none above.
    second = _summed(first, ["data_id", "node_id"], [*exps, *(exps[-1] - exact.BITS * (k + 1) for k in range(3) if exps[-1] - exact.BITS * (k + 1) > exact.LEAST)])
    each = Window.partitionBy("data_id")
    base = F.max(F.when(F.col("node_id") < 1000, F.col("node_id"))).over(each)
    high = F.col("node_id") > 1000
    number = F.row_number().over(Window.partitionBy("data_id", high).orderBy(F.desc("node_id")))
    return second.withColumns({"_base": base, "_n": number}).withColumn("node_id", F.when(high, F.coalesce("_base", F.lit(-1)) + F.col("_n")).otherwise(F.col("node_id"))).drop("_base", "_n")


def _reflected_runs(plane_column: Column, height: Column, width: Column) -> Column:
    """Runs of a mask mirrored about a column, piece by piece; pieces that fall outside go."""
    pieces = lambda r: F.transform(F.sequence(F.floor(r["start"] / height), F.floor((r["end"] - 1) / height)), lambda c: F.struct((2 * plane_column - c).alias("c"), (F.greatest(r["start"], c * height) - c * height).alias("top"), (F.least(r["end"], (c + 1) * height) - c * height).alias("bottom")))
    inside = F.filter(F.flatten(F.transform("runs", pieces)), lambda p: (p["c"] >= 0) & (p["c"] < width))
    return _united(F.transform(inside, lambda p: F.struct((p["c"] * height + p["top"]).cast("bigint").alias("start"), (p["c"] * height + p["bottom"]).cast("bigint").alias("end"))))


def _with(rows: DataFrame, keys: list[str], whole: bool, **values: Column) -> DataFrame:
    """``rows`` with aggregates over those with the same keys: joined, or with ``whole`` over rows that lie in one task."""
    if whole:
        return rows.withColumns({name: value.over(Window.partitionBy(*keys)) for name, value in values.items()})
    return rows.join(rows.groupBy(*keys).agg(*(value.alias(name) for name, value in values.items())), keys)


def mirror(nodes: DataFrame, whole: bool = False) -> DataFrame:
    """Nodes with their mirror images; those on the plane (the mean of specular_origin_1) have none. Nodes without an image go.
    With ``whole`` an image's nodes are gathered in one task, and nothing is joined."""
    rows = _with(nodes, ["data_id"], whole, _plane=F.avg("specular_origin_1"), _last=F.max("seq")).filter("data_id IS NOT NULL")
    p = F.col("_plane")
    rows = rows.withColumn("_side", F.coalesce(F.signum(F.col("centroid_1") - p), F.lit(0.0)))
    left, moves = F.col("_side") < 0, F.col("_side") != 0
    flipped = {
        "centroid_1": mirrored(F.col("centroid_1"), p),
        "intensity_centroid_1": -F.col("intensity_centroid_1"),
        "relative_centroid_1": -F.col("relative_centroid_1"),
        "bbox_minc": mirrored_edge(F.col("bbox_maxc"), p),
        "bbox_maxc": mirrored_edge(F.col("bbox_minc"), p),
        "node_id": F.col("node_id") + F.when(left, 1000).otherwise(2000),
        "seq": F.col("seq") + (F.col("_last") + 1) * F.when(left, 1).otherwise(2),
    }
    if "runs" in nodes.columns:
        # The mask turns about the origin of the first mirrored node of its side.
        rows = _with(rows, ["data_id", "_side"], whole, _origin=F.min_by("specular_origin_1", "seq"))
        flipped["runs"] = _reflected_runs(F.rint("_origin").cast("bigint"), F.col("mask_height").cast("bigint"), F.col("mask_width").cast("bigint"))
    # The image's id stays outside, so that Spark sees that its nodes lie where they lay.
    rest = [f for f in nodes.schema if f.name != "data_id"]
    image = F.struct(*(flipped.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in rest))
    return rows.select("data_id", F.inline(F.array_compact(F.array(F.struct(*(f.name for f in rest)), F.when(moves, image))))).select(*nodes.columns)


def _settled_whole(nodes: DataFrame, passes: int) -> DataFrame:
    """Nodes of the symmetrised patterns of images that lie in one task each: mirrored and merged there, without a join or a table."""
    means = _columns(nodes, MEANS)
    first = F.row_number().over(Window.partitionBy("data_id").orderBy("seq")) == 1
    own = {"seq": "bigint", "node_id": "bigint", "runs": "array<struct<start:bigint,end:bigint>>"} | dict.fromkeys(means, "double")
    ready = mirror(nodes, whole=True).withColumn("_first", first).sortWithinPartitions("data_id", "seq").withColumns({c: F.col(c).cast(t) for c, t in own.items() if c in nodes.columns})
    schema = StructType([StructField(f.name, f.dataType) for f in ready.drop("_first").schema])
    return ready.mapInArrow(partial(settling.settled, means=means, box=BOX, passes=passes), schema)


def _settled(nodes: DataFrame, passes: int) -> DataFrame:
    """Nodes of the symmetrised patterns of images of any size. Passes are repeated until an image's number of nodes stays; such
    images are set aside with the pass that showed it, the others go on. No image is gathered, and each pass is a table."""
    rows = cut(mirror(nodes), "mirrored")
    done: DataFrame | None = None
    for _ in range(passes):
        new = cut(merge_pass(rows).select(*nodes.columns), "pass")
        before, after = (x.groupBy("data_id").agg(F.count("*").alias(n)) for x, n in ((rows, "n0"), (new, "n1")))
        still = before.join(after, "data_id").filter("n0 = n1").select("data_id")
        still = cut(still, "still")
        settled = new.join(still, "data_id", "left_semi")
        done = settled if done is None else done.unionByName(settled)
        rows = cut(new.join(still, "data_id", "left_anti"), "rest")
        if rows.isEmpty():
            return done
    raise RuntimeError("a pattern did not settle")


def symmetrised(nodes: DataFrame, passes: int = MOST_PASSES, whole: int = WHOLE, together: bool = False, each: int = EACH) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the symmetrised patterns of all images at once.

    An image of up to ``whole`` nodes is mirrored and merged in one task: nodes are dealt out once by image, to partitions of about
    ``each``, and nothing is joined or written. ``together`` says that the caller has dealt them out so. Larger images are merged by
    joins, pass by pass. An image that still changes after ``passes`` passes raises. Empty input gives empty tables.
    """
    keep = ["data_id", "seq", "node_id", *_columns(nodes, MEANS), *_columns(nodes, FIRSTS), *(["runs"] if "runs" in nodes.columns else [])]
    nodes = nodes.select(*keep)
    sizes = nodes.groupBy("data_id").agg(F.count("*").alias("n"))
    rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    small = nodes
    if most > whole:
        large = cut(sizes.filter(F.col("n") > whole).select("data_id"), "large")
        small = nodes.join(large, "data_id", "left_anti")
    found = _settled_whole(small if together else dealt(small, ["data_id"], rows, each), passes)
    if most > whole:
        found = found.unionByName(_settled(nodes.join(large, "data_id", "left_semi"), passes))
    return found, edges(found, rows=2 * rows)

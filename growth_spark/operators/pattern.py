"""Features and edges of diffraction patterns, in long form until a caller asks for columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import boxes_overlap, edge_metrics, horizontal_overlap
from ..plans import tables

# The features of a node.
FEATURES = ("spot_area", "streak_area", "relative_centroid_0", "relative_centroid_1", "intensity_centroid_0", "intensity_centroid_1", "specular_origin_0", "specular_origin_1", "fwhm_0", "fwhm_1", "area", "eccentricity", "center_distance", "axis_major_length", "axis_minor_length", "roughness_metric")
EDGE = ("weight", "horizontal_weight", "vertical_weight", "horizontal_overlap")


def edges(nodes: DataFrame, each: int = tables.EACH, rows: int | None = None) -> DataFrame:
    """Each pair of nodes of an image, smaller id first, with distances and whether they overlap horizontally.

    Of nodes of one id one is taken, so pairs need not be told apart afterwards. Images are dealt out once, to partitions of
    about ``each`` nodes, which both sides of the join share. ``rows`` is about the number of nodes, where the caller has it.
    """
    columns = ["node_id", "centroid_0", "centroid_1", "bbox_minc", "bbox_maxc"]
    nodes = tables.dealt(nodes.select("data_id", *columns), ["data_id"], nodes.count() if rows is None else rows, each).dropDuplicates(["data_id", "node_id"])
    x, y = (nodes.select("data_id", *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in ("x", "y"))
    weight, across, down = edge_metrics((F.col("centroid_0_x"), F.col("centroid_1_x")), (F.col("centroid_0_y"), F.col("centroid_1_y")))
    overlap = horizontal_overlap(*(F.col(c) for c in ("bbox_minc_x", "bbox_maxc_x", "bbox_minc_y", "bbox_maxc_y")))
    pairs = x.join(y, (x["data_id"] == y["data_id"]) & (x["node_id_x"] < y["node_id_y"])).drop(y["data_id"])
    return pairs.select("data_id", F.col("node_id_x").alias("start_node"), F.col("node_id_y").alias("end_node"), *(c.alias(n) for c, n in zip((weight, across, down, overlap), EDGE, strict=True)))


#: Boxes of an image up to which each is compared with all of its image.
FEW = 64


def overlapping(boxes: DataFrame, cell: float = 1, few: int = FEW) -> DataFrame:
    """(data_id, a, b) of boxes (data_id, seq, minr, minc, maxr, maxc) that share a point, each with itself too.

    Boxes of an image with more than ``few`` lie in square cells of a grid as coarse as they are large (its sides are ``cell``
    times powers of two), so a box touches four cells at most, whatever its size. It looks for others there and in the
    coarser grids that are in use. A pair is found once: in the cell that holds the first corner of what the two share.
    Boxes with a null side share nothing.
    """
    own = ["minr", "minc", "maxr", "maxc"]
    rows = boxes.select("data_id", "seq", *(F.col(c).cast("double").alias(c) for c in own)).filter(" AND ".join(f"{c} IS NOT NULL" for c in own))
    crowded = rows.groupBy("data_id").agg((F.count("*") > few).alias("_many"))
    longest = F.greatest(F.col("maxr") - F.col("minr"), F.col("maxc") - F.col("minc"), F.lit(float(cell)))
    level = F.when(F.col("_many"), F.ceil(F.log2(longest / cell)).cast("int")).otherwise(-1)
    levelled = rows.join(crowded, "data_id").withColumn("_level", level)

    def cells(at: Column) -> Column:
        side = F.lit(float(cell)) * F.pow(F.lit(2.0), at)
        line = lambda lo, hi: F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side))
        touched = F.flatten(F.transform(line("minr", "maxr"), lambda r: F.transform(line("minc", "maxc"), lambda c: F.struct(r.alias("r"), c.alias("c")))))
        whole = F.array(F.struct(F.lit(0).cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("c")))
        return F.when(at < 0, whole).otherwise(touched)

    used = levelled.agg(F.collect_set("_level").alias("_used"))  # one row, some ten levels
    looked = levelled.join(F.broadcast(used)).withColumn("_at", F.explode(F.filter("_used", lambda x: F.when(F.col("_level") < 0, x == -1).otherwise(x >= F.col("_level")))))
    side = lambda df, s: df.withColumn("_cell", F.explode(cells(F.col("_at")))).select("data_id", "_at", "_cell", *(F.col(c).alias(f"{s}_{c}") for c in ("seq", *own)), F.col("_level").alias(f"{s}_level"))
    met = side(looked, "a").join(side(levelled.withColumn("_at", F.col("_level")), "b"), ["data_id", "_at", "_cell"]).filter(boxes_overlap("a_", "b_"))
    width = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_at"))
    corner = [F.floor(F.greatest(f"a_{c}", f"b_{c}") / width) for c in ("minr", "minc")]
    once = met.filter((F.col("_at") < 0) | (F.col("_cell.r") == corner[0]) & (F.col("_cell.c") == corner[1]))
    pair = F.struct(F.col("a_seq").alias("a"), F.col("b_seq").alias("b"))
    back = F.struct(F.col("b_seq").alias("a"), F.col("a_seq").alias("b"))
    # Within a level both look for each other; across levels only the smaller box looks.
    both = once.select("data_id", F.explode(F.when(F.col("a_level") == F.col("b_level"), F.array(pair)).otherwise(F.array(pair, back))).alias("_p"))
    return both.select("data_id", "_p.a", "_p.b")


def features_long(nodes: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(data_id, feature, node_id, value): the mean where a node id repeats, nulls left out."""
    return nodes.select("data_id", "node_id", *[F.col(f).cast("double").alias(f) for f in features]).unpivot(["data_id", "node_id"], list(features), "feature", "value").groupBy("data_id", "feature", "node_id").agg(F.avg("value").alias("value")).filter("value IS NOT NULL")


def streamlined(rows: DataFrame) -> DataFrame:
    """Without features of nodes that some image lacks."""
    images = rows.select("data_id").distinct().agg(F.count("*").alias("images"))
    there = rows.groupBy("feature", "node_id").agg(F.count_distinct("data_id").alias("c")).join(F.broadcast(images)).filter("c = images")
    return rows.join(there.select("feature", "node_id"), ["feature", "node_id"], "left_semi")


def normalised(rows: DataFrame) -> DataFrame:
    """Values less their column's mean over its sample deviation (plus 1e-6); null for a column of one image.

    Means and deviations are aggregated before they are joined back, so a feature of all images makes no hot window.
    """
    stats = rows.groupBy("feature", "node_id").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    return rows.join(stats, ["feature", "node_id"]).withColumn("value", (F.col("value") - F.col("_m")) / (F.col("_s") + 1e-6)).drop("_m", "_s")


def collection_features(nodes: DataFrame, streamline: bool = False, normalize: bool = False, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """All features of a collection's images: without those that some image lacks, and normalised, where asked for."""
    rows = features_long(nodes, features)
    rows = streamlined(rows) if streamline else rows
    return normalised(rows) if normalize else rows


def wide(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row an image, a column for each of ``keys`` (``feature_node``), which the caller names."""
    return rows.withColumn("key", F.concat_ws("_", "feature", "node_id")).groupBy("data_id").pivot("key", keys).agg(F.avg("value"))


def with_extra(features: DataFrame, extra: DataFrame) -> DataFrame:
    return features.join(extra, "data_id", "inner")


def collection(images: DataFrame, extra: DataFrame | None = None, sort_key: str | None = None) -> DataFrame:
    """Images (pos, data_id, …) with their extra attributes by position, numbered before sorting; ties keep position.

    A missing sort key and extra rows of another number than the images are errors.
    """
    rows = tables.numbered(images, ["pos"], "pattern_id") if "pattern_id" not in images.columns else images
    if extra is not None:
        both = images.select("pos").join(extra.select("pos"), "pos", "full_outer").count()
        if both != images.count() or both != extra.count():
            raise ValueError("extra data and images differ in number")
        rows = rows.join(extra, "pos")
    if sort_key is None:
        return rows.orderBy("pos")
    if sort_key not in rows.columns:
        raise KeyError(sort_key)
    return rows.orderBy(sort_key, "pos")


def at(rows: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """The images at positions start … stop - 1, or the one at ``start``; negative positions count from the end.

    A single position outside of the collection is an error, a range only loses what lies outside.
    """
    if start < 0 or stop is not None and stop < 0:
        n = length(rows)
        if start < 0 and stop is not None:
            start = max(start + n, 0)
        elif start < 0:
            start += n
        stop = stop + n if stop is not None and stop < 0 else stop
    if stop is not None:
        return rows.filter((F.col("pos") >= start) & (F.col("pos") < stop))
    found = rows.filter(F.col("pos") == start)
    if found.isEmpty():
        raise IndexError(start)
    return found


def length(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.max("pos") + 1, F.lit(0))).first()[0]


def largest_size(images: DataFrame) -> DataFrame:
    """(collection_id, image_width, image_height): the greatest of each, apart from the other."""
    return images.groupBy("collection_id").agg(F.max("image_width").alias("image_width"), F.max("image_height").alias("image_height"))


def extra_keys(images: DataFrame, column: str = "extra") -> DataFrame:
    """(collection_id, key): the different keys of the images' extra attributes (a map); null maps have none."""
    return images.select("collection_id", F.explode(F.map_keys(column)).alias("key")).distinct()


def relabelled(nodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Nodes with linked ids (data_id, node_id, linked_id); node 0 keeps its id."""
    rows = nodes.join(mapping, ["data_id", "node_id"], "left")
    return rows.withColumn("node_id", F.when(F.col("node_id") == 0, F.lit(0)).otherwise(F.coalesce("linked_id", "node_id"))).drop("linked_id")


def first_seen_code(rows: DataFrame) -> DataFrame:
    """(data_id, frame): ids numbered in the order in which they first occur."""
    first = rows.groupBy("collection_id", "data_id").agg(F.min("seq").alias("seq"))
    return first.withColumn("frame", F.dense_rank().over(Window.partitionBy("collection_id").orderBy("seq")) - 1).drop("seq")

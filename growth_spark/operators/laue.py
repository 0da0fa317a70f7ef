"""Radius of the zeroth-order Laue zone: circles through a point, scored by the brightness of their pixels."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..plans.tables import cut
from .symmetry import symmetrised

RADII, ANGLES, LOW, HIGH, BEST = 2000, 1440, 100.0, 1400.0, 30


def centres(nodes: DataFrame) -> DataFrame:
    """(data_id, cy, cx): intensity centroid plus specular origin of the node of smallest id."""
    point = F.struct((F.col("intensity_centroid_0") + F.col("specular_origin_0")).alias("cy"), (F.col("intensity_centroid_1") + F.col("specular_origin_1")).alias("cx"))
    return nodes.groupBy("data_id").agg(F.min_by(point, "node_id").alias("c")).select("data_id", "c.cy", "c.cx")


class Circles:
    """The circles that are tried, made once a task: every one of ``radii`` radii from ``low`` to ``high`` with ``angles`` angles,
    both ends of either range included, so the first and the last angle are one point."""

    #: Points that are looked up at a time.
    LOT = 1 << 18

    def __init__(self, radii: int, angles: int, low: float, high: float) -> None:
        self.radii = low + np.arange(radii) * ((high - low) / max(radii - 1, 1))
        theta = [j * (2 * math.pi / max(angles - 1, 1)) for j in range(angles)]
        self.cos, self.sin = np.array([math.cos(t) for t in theta]), np.array([math.sin(t) for t in theta])

    def scores(self, image: np.ndarray, width: int, cy: float, cx: float) -> np.ndarray:
        """The 0.9 quantile of the pixels on each circle through (cy, cx); NaN where no pixel is on it."""
        height = len(image) // width
        out = np.full(len(self.radii), np.nan)
        lot = max(self.LOT // len(self.cos), 1)
        for a in range(0, len(self.radii), lot):
            r = self.radii[a : a + lot, None]
            x, y = np.rint(r * self.cos + cx), np.rint(r * self.sin + cy - r)
            on = (x >= 0) & (y >= 0) & (x < width) & (y < height)
            values = np.full(on.shape, np.nan)
            values[on] = image[y[on].astype(np.int64) * width + x[on].astype(np.int64)]
            values.sort(axis=1)  # missing pixels last
            n = np.count_nonzero(~np.isnan(values), axis=1)
            rows = np.flatnonzero(n)
            at = (n[rows] - 1) * 0.9
            below = values[rows, np.floor(at).astype(np.int64)]
            out[a + rows] = below + (values[rows, np.ceil(at).astype(np.int64)] - below) * (at - np.floor(at))
        return out


def _by_image(images: DataFrame, points: DataFrame, circles: tuple, made: Callable[[np.ndarray, np.ndarray], list[tuple]], columns: str) -> DataFrame:
    """``made`` (of radii and scores) for each image with its point: an image is held once, and all circles drawn on it."""
    rows = images.join(points, "data_id").select("data_id", F.col("image").cast("array<double>").alias("image"), F.col("width").cast("bigint").alias("width"), F.col("cy").cast("double").alias("cy"), F.col("cx").cast("double").alias("cx"))
    rows = rows.filter("image IS NOT NULL AND size(image) > 0 AND width > 0 AND cy IS NOT NULL AND cx IS NOT NULL")
    schema = StructType([rows.schema["data_id"], *StructType.fromDDL(columns).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = Circles(*circles)
        for batch in batches:
            for i in range(batch.num_rows):
                image = batch.column("image")[i].values.to_numpy(zero_copy_only=False)
                width, cy, cx = (batch.column(c)[i].as_py() for c in ("width", "cy", "cx"))
                found = made(drawn.radii, drawn.scores(image, width, cy, cx))
                ids = pa.array([batch.column("data_id")[i].as_py()] * len(found), arrow.field("data_id").type)
                rest = [pa.array([r[k] for r in found], arrow.field(k + 1).type) for k in range(len(arrow) - 1)]
                yield pa.RecordBatch.from_arrays([ids, *rest], schema=arrow)

    return rows.mapInArrow(run, schema)


def scores(images: DataFrame, points: DataFrame, radii: int = RADII, angles: int = ANGLES, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(data_id, radius, score): the 0.9 quantile of the pixels on each circle through its image's point (cy, cx).

    ``images`` are (data_id, image: one array in row order, width). Points off the image and pixels that are null or NaN
    don't count, repeated pixels count each time. Circles without any pixel give no row; neither do images without pixels
    or point.
    """

    def made(radius: np.ndarray, score: np.ndarray) -> list[tuple]:
        return [(r, s) for r, s in zip(radius.tolist(), score.tolist(), strict=True) if s == s]

    return _by_image(images, points, (radii, angles, low, high), made, "radius double, score double")


def best_radius(scored: DataFrame, points: DataFrame, best: int = BEST) -> DataFrame:
    """(data_id, radius, cy, cx): the mean of the best radii and the centre of its circle. Each score keeps its radius."""
    order = Window.partitionBy("data_id").orderBy(F.desc("score"), F.desc("radius"))
    top = scored.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= best).groupBy("data_id").agg(F.avg("radius").alias("radius"))
    return top.join(points, "data_id").select("data_id", "radius", (F.col("cy") - F.col("radius")).alias("cy"), "cx")


def zero_radius(nodes: DataFrame, images: DataFrame, radii: int = RADII, angles: int = ANGLES, low: float = LOW, high: float = HIGH, best: int = BEST, digits: int | None = None) -> DataFrame:
    """(data_id, radius, cy, cx) of each image from its pattern's nodes: the nodes are symmetrised, their point is taken, all
    circles through it are scored, and the best radii's mean gives the circle. One row an image; scores stay in the task.

    Images without nodes, or with no pixel on any circle, give no row. ``digits`` rounds scores before they are ranked.
    """
    found, _ = symmetrised(nodes)
    points = cut(centres(found), "points")

    def made(radius: np.ndarray, score: np.ndarray) -> list[tuple]:
        there = np.flatnonzero(~np.isnan(score))
        ranked = np.round(score[there], digits) if digits is not None else score[there]
        top = there[np.lexsort((-radius[there], -ranked))[:best]]
        return [(float(radius[top].mean()),)] if len(top) else []

    circles = _by_image(images, points, (radii, angles, low, high), made, "radius double")
    return circles.join(points, "data_id").select("data_id", "radius", (F.col("cy") - F.col("radius")).alias("cy"), "cx")

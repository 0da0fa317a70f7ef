"""Geometry of diffraction patterns as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def boxes_overlap(a: str, b: str) -> Column:
    """Closed rectangles ``{a}minr … {a}maxc`` and ``{b}…`` share a point."""
    col = F.col
    return (col(f"{a}minr") <= col(f"{b}maxr")) & (col(f"{b}minr") <= col(f"{a}maxr")) & (col(f"{a}minc") <= col(f"{b}maxc")) & (col(f"{b}minc") <= col(f"{a}maxc"))


def horizontal_overlap(minc_x: Column, maxc_x: Column, minc_y: Column, maxc_y: Column) -> Column:
    """The region further left reaches into the other; with equal left edges the second stands for both."""
    left_end = F.when(minc_x < minc_y, maxc_x).otherwise(maxc_y)
    right_start = F.when(minc_x > minc_y, minc_x).otherwise(minc_y)
    return left_end > right_start


def normalised(x: Column, y: Column, width: Column, height: Column) -> tuple[Column, Column]:
    return x / width, y / height


def polar(x: Column, y: Column, x0: Column, y0: Column, scale: Column | float = 1.0) -> tuple[Column, Column]:
    """Radius (over ``scale``) and angle of a point as seen from an origin."""
    return F.sqrt((x - x0) ** 2 + (y - y0) ** 2) / scale, F.atan2(y - y0, x - x0)


def rescaled(x: Column, y: Column, x0: Column, y0: Column, scale: Column | float) -> tuple[Column, Column]:
    """The point rescaled about the origin; the first result is the vertical part, as users rely on."""
    r, angle = polar(x, y, x0, y0, scale)
    return r * F.sin(angle), r * F.cos(angle)


def edge_metrics(x: tuple[Column, Column], y: tuple[Column, Column]) -> tuple[Column, Column, Column]:
    """Euclidean, horizontal (second axis) and vertical (first axis) distance."""
    down, across = x[0] - y[0], x[1] - y[1]
    return F.hypot(down, across), F.abs(across), F.abs(down)


def mirrored(x: Column, plane: Column) -> Column:
    return 2 * plane - x


def mirrored_edge(x: Column, plane: Column) -> Column:
    """A box edge mirrored, cut towards zero to a whole pixel."""
    return (2 * plane - x).cast("int")


def pixel(x: Column) -> Column:
    """The nearest pixel, halves to the even one."""
    return F.rint(x).cast("int")


def search_radius(width: Column, height: Column, share: Column | float) -> Column:
    return F.hypot(width.cast("double"), height.cast("double")) * share

"""Patterns linked across the images of a collection: nearest assignments with a memory of one image."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..plans import tables

#: Points of a collection, and of one of its images, up to which one task follows the collection as it is.
WHOLE, IMAGE = 1 << 16, 256
RESULT = ["collection_id", "data_id", "node_id"]


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, one for each row; at least as many columns as rows.

    Shortest augmenting paths with potentials.
    """
    n, m = cost.shape
    u, v = np.zeros(n), np.zeros(m)
    row_of = np.full(m, -1)
    for i in range(n):
        least, via, seen = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, col = i, -1
        while True:
            reduced = cost[row] - u[row] - v
            better = ~seen & (reduced < least)
            least[better], via[better] = reduced[better], col
            nxt = int(np.argmin(np.where(seen, np.inf, least)))
            delta = least[nxt]
            u[i] += delta
            for c in np.flatnonzero(seen):
                u[row_of[c]] += delta
                v[c] -= delta
            least[~seen] -= delta
            seen[nxt] = True
            col = nxt
            if row_of[nxt] < 0:
                break
            row = row_of[nxt]
        while col >= 0:
            before = via[col]
            row_of[col] = i if before < 0 else row_of[before]
            col = before
    return [(int(r), int(c)) for c, r in enumerate(row_of) if r >= 0]


def groups_of(pairs: list[tuple[int, int]]) -> Iterator[tuple[list[int], list[int]]]:
    """Connected groups of candidates: they can be assigned apart."""
    left: dict[int, set[int]] = {}
    right: dict[int, set[int]] = {}
    for a, b in pairs:
        left.setdefault(a, set()).add(b)
        right.setdefault(b, set()).add(a)
    seen: set[int] = set()
    for start in left:
        if start in seen:
            continue
        own, theirs, todo = {start}, set(), [start]
        while todo:
            for b in left[todo.pop()] - theirs:
                theirs.add(b)
                new = right[b] - own
                own |= new
                todo += new
        seen |= own
        yield sorted(own), sorted(theirs)


Known = dict[int, tuple[int, np.ndarray]]


def follow(known: Known, frame: int, points: np.ndarray, xy: np.ndarray, reach: float, memory: int = 1) -> tuple[np.ndarray, Known]:
    """The id of the point at which the track of each point of an image starts, and the tracks known after it.

    ``known`` holds where each track of the images before was seen last: (frame, position) by the id of its first point.
    Tracks go on with least total squared displacement within ``reach``. A track is looked for in the next image and, if it
    is missing there, in ``memory`` more. Leaving a point without a partner costs the squared reach.
    """
    known = {t: k for t, k in known.items() if frame - k[0] <= memory + 1}
    starts = points.copy()
    if known:
        ids = list(known)
        d2 = ((xy[:, None, :] - np.array([at for _, at in known.values()])[None]) ** 2).sum(2)
        near = np.argwhere(d2 <= reach**2).tolist()
        for own, theirs in groups_of(near):
            if len(own) == len(theirs) == 1:
                starts[own[0]] = ids[theirs[0]]
                continue
            square = np.full((len(own), len(theirs) + len(own)), 1e18)
            within = d2[np.ix_(own, theirs)]
            square[:, : len(theirs)] = np.where(within <= reach**2, within, 1e18)
            square[np.arange(len(own)), len(theirs) + np.arange(len(own))] = reach**2
            for i, j in assign(square):
                if j < len(theirs):
                    starts[own[i]] = ids[theirs[j]]
    known.update(zip(starts.tolist(), ((frame, at) for at in xy), strict=True))
    return starts, known


def tracked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(point, start) of points (root, frame, point, x, y, reach) that come sorted by root and frame.

    Only the tracks of the last images and an image that may go on in the next batch are held.
    """
    rest, root, known = None, None, {}
    for batch in itertools.chain(batches, [None]):
        rows = pd.concat([r for r in (rest, batch) if r is not None]) if rest is not None or batch is not None else None
        if rows is None or rows.empty:
            continue
        roots, frames, points, reach = (rows[c].to_numpy() for c in ("root", "frame", "point", "reach"))
        xy = rows[["x", "y"]].to_numpy(float)
        ends = (np.flatnonzero((np.diff(roots) != 0) | (np.diff(frames) != 0)) + 1).tolist()
        ends = ends if batch is not None else [*ends, len(rows)]
        starts = points.copy()
        for a, b in itertools.pairwise([0, *ends]):
            if roots[a] != root:
                root, known = roots[a], {}
            starts[a:b], known = follow(known, int(frames[a]), points[a:b], xy[a:b], float(reach[a]))
        done = ends[-1] if ends else 0
        rest = rows.iloc[done:]
        yield pd.DataFrame({"point": points[:done], "start": starts[:done]})


def candidates(points: DataFrame, memory: int = 1) -> DataFrame:
    """(a, b): points of one collection within reach of each other, at most ``memory`` images between theirs.

    Joined by frame and by cells twice as wide as the reach, of which a point's surroundings meet at most four.
    """
    side = F.when(F.col("reach") > 0, 2 * F.col("reach")).otherwise(1.0)
    cell = lambda at: F.floor(at / side)
    met = lambda c: F.explode(F.array_distinct(F.array(cell(F.col(c) - F.col("reach")), cell(F.col(c) + F.col("reach")))))
    known = points.filter("x IS NOT NULL AND y IS NOT NULL")
    later = known.select(F.col("collection_id").alias("_c"), "frame", cell(F.col("x")).alias("cx"), cell(F.col("y")).alias("cy"), F.col("point").alias("b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(memory + 1)))
    earlier = known.withColumn("gap", steps).withColumn("frame", F.col("frame") + F.col("gap")).withColumn("cx", met("x")).withColumn("cy", met("y"))
    both = earlier.alias("e").join(later.alias("l"), F.col("collection_id").eqNullSafe(F.col("_c")) & (F.col("e.frame") == F.col("l.frame")) & (F.col("e.cx") == F.col("l.cx")) & (F.col("e.cy") == F.col("l.cy")))
    return both.filter((F.col("x") - F.col("xb")) ** 2 + (F.col("y") - F.col("yb")) ** 2 <= F.col("reach") ** 2).select(F.col("point").alias("a"), "b")


def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points (root, frame, placed, point, x, y, reach) of whole collections, sorted by root, frame and place in the image, with the
    numbers of their tracks instead.

    Tracks are numbered as they begin. Only those of the last images and an image that may go on in the next batch are held.
    """
    rest, root, known, numbers, count = None, None, {}, {}, 0
    for batch in itertools.chain(batches, [None]):
        rows = pa.concat_tables([t for t in (rest, None if batch is None else pa.Table.from_batches([batch])) if t is not None] or [pa.table({})])
        if not rows.num_rows:
            continue
        roots, frames, placed, points, x, y, reach = (rows[c].to_numpy() for c in ("root", "frame", "placed", "point", "x", "y", "reach"))
        xy = np.stack([x, y], axis=1)
        ends = (np.flatnonzero((np.diff(roots) != 0) | (np.diff(frames) != 0)) + 1).tolist()
        ends = ends if batch is not None else [*ends, len(roots)]
        done = ends[-1] if ends else 0
        found = np.empty(done, np.int64)
        for a, b in itertools.pairwise([0, *ends]):
            if roots[a] != root:
                root, known, numbers, count = roots[a], {}, {}, 0
            starts, there = points[a:b].copy(), placed[a:b]
            if there.any():
                starts[there], known = follow(known, int(frames[a]), points[a:b][there], xy[a:b][there], float(reach[a]))
            for k, (point, start) in enumerate(zip(points[a:b].tolist(), starts.tolist(), strict=True), a):
                if point == start:
                    count += 1
                    numbers[start] = count
                found[k] = numbers[start]
            numbers = {t: numbers[t] for t in known}
        rest = rows.slice(done)
        yield from rows.slice(0, done).select(RESULT).append_column("linked_id", pa.array(found)).to_batches()


def linked_whole(points: DataFrame, rows: int) -> DataFrame:
    """``linked`` of collections that are small enough to be followed each in one task: dealt out once, and nothing is joined."""
    placed = F.col("frame").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    order = ["frame", "seq", "point"]
    # Any number that tells a collection from the next one serves: that of its first point, whatever the collection's own id is.
    root = F.first("point").over(Window.partitionBy("collection_id").orderBy(*order))
    dealt = tables.dealt(points, ["collection_id"], rows).withColumns({"root": root, "placed": placed}).sortWithinPartitions("collection_id", *order)
    ready = dealt.select(*RESULT, "root", F.coalesce(F.col("frame").cast("bigint"), F.lit(-(1 << 63))).alias("frame"), "placed", "point", "x", "y", F.coalesce("reach", F.lit(math.nan)).alias("reach"))
    schema = StructType([*(points.schema[c] for c in RESULT), StructField("linked_id", LongType())])
    return ready.mapInArrow(followed, schema)


def linked(nodes: DataFrame, whole: int = WHOLE, image: int = IMAGE) -> DataFrame:
    """(collection_id, data_id, node_id, linked_id) of nodes (collection_id, data_id, node_id, seq, frame, x, y, reach).

    ``reach`` is the largest image's diagonal times the search range, computed by the caller, one for each collection.
    Linked ids number the tracks of a collection by their first image and ``seq``, from 1, as node 0 is reserved. Points without
    a position are tracks of their own. A collection of up to ``whole`` points, and ``image`` in each image, is followed in one
    task; a larger one by connected groups of candidates.
    """
    columns = ["collection_id", "data_id", "node_id", "seq", "frame", F.col("x").cast("double"), F.col("y").cast("double"), F.col("reach").cast("double")]
    points = tables.cut(nodes.select(*columns).withColumn("point", F.monotonically_increasing_id()), "points")
    sizes = points.groupBy("collection_id", "frame").agg(F.count("*").alias("n")).groupBy(F.col("collection_id").alias("_large")).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    large = tables.cut(sizes.filter((F.col("n") > whole) | (F.col("most") > image)).select("_large"), "large")
    rows = points.count()
    if large.isEmpty():
        return linked_whole(points, rows)
    own = F.col("collection_id").eqNullSafe(F.col("_large"))
    by_groups = linked_by_groups(tables.cut(points.join(large, own, "left_semi"), "points"))
    return linked_whole(points.join(large, own, "left_anti"), rows).unionByName(by_groups)


def linked_by_groups(points: DataFrame) -> DataFrame:
    """``linked`` of points of collections of any size: connected groups of candidates are followed in parallel, the images of
    one in order and two at a time, so neither a large collection nor a long track is gathered."""
    roots = tables.components(candidates(points), "links")
    ready = points.join(roots.withColumnRenamed("node", "point"), "point").select("root", "frame", "seq", "point", "x", "y", "reach")
    starts = ready.repartition("root").sortWithinPartitions("root", "frame", "seq", "point").drop("seq").mapInPandas(tracked, "point bigint, start bigint")
    known = tables.cut(points.join(starts, "point", "left").withColumn("start", F.coalesce("start", "point")), "tracks")

    first = known.filter("start = point")
    own = first.select("collection_id", "frame", "start", F.row_number().over(Window.partitionBy("collection_id", "frame").orderBy("seq", "point")).alias("own"))
    before = F.sum("n").over(Window.partitionBy("collection_id").orderBy("frame")) - F.col("n")
    counts = first.groupBy("collection_id", "frame").agg(F.count("*").alias("n")).select(F.col("collection_id").alias("_c"), F.col("frame").alias("_f"), before.alias("before"))
    numbers = own.join(counts, F.col("collection_id").eqNullSafe(F.col("_c")) & F.col("frame").eqNullSafe(F.col("_f"))).select("start", (F.col("own") + F.col("before")).alias("linked_id"))
    return known.join(numbers, "start").select("collection_id", "data_id", "node_id", "linked_id")

"""Patterns of whole images merged in one task, many small images at once."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs of nodes that are compared at once, about.
PAIRS = 1 << 20
#: Stands for a missing id or number, which comes last.
LAST = (1 << 63) - 1

Values = tuple[np.ndarray, np.ndarray]


def mean(values: Values, members: np.ndarray, starts: np.ndarray) -> Values:
    """Means of the members of each group and whether there is one: their exact sum, rounded, over their number; missing values
    don't count. A group's members lie together, from its start on."""
    x, there = values[0][members], values[1][members]
    sizes = np.diff(np.append(starts, len(members)))
    group = np.repeat(np.arange(len(starts)), sizes)
    if not there.all():
        x, group = x[there], group[there]
        sizes = np.bincount(group, minlength=len(starts))
        starts = np.cumsum(sizes) - sizes
    # The sum of two is rounded once, whatever their order.
    total = np.bincount(group, x, len(starts))
    many, terms = np.flatnonzero(sizes > 2), x.tolist()
    for k, a, n in zip(many.tolist(), starts[many].tolist(), sizes[many].tolist(), strict=True):
        try:
            total[k] = math.fsum(terms[a : a + n])
        except (OverflowError, ValueError):  # infinite: the plain sum says which, or that there is none
            pass
    return total / np.maximum(sizes, 1), sizes > 0


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before in a key."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _below(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a <= b) | np.isnan(b)  # NaN is the greatest, as in Spark


def _united(runs: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(itertools.chain.from_iterable(runs)):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _gathered(runs: list | None, members: np.ndarray, starts: np.ndarray) -> list | None:
    if runs is None:
        return None
    ends = np.append(starts, len(members))[1:]
    return [_united([runs[m] for m in members[a:b].tolist()]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _numbered(image: np.ndarray, node: np.ndarray, images: int) -> np.ndarray:
    """Ids above 1000 numbered on from the image's largest below, the largest first. Rows come by image and id."""
    low, high = node < 1000, (node > 1000) & (node < LAST)
    base = np.full(images, -LAST)
    np.maximum.at(base, image[low], node[low])
    base[base == -LAST] = -1
    count = np.bincount(image[high], minlength=images)
    place = np.arange(high.sum()) - (np.cumsum(count) - count)[image[high]]
    out = node.copy()
    out[high] = (base + count)[image[high]] - place
    return out


def settle(rows: pa.Table, counts: np.ndarray, means: list[str], box: tuple[str, ...], passes: int) -> Iterator[pa.RecordBatch]:
    """Passes over images with these numbers of rows, sorted by image and seq, until the number of an image's nodes stays."""
    image = np.repeat(np.arange(len(counts)), counts)
    seq, node = (rows[c].fill_null(LAST).to_numpy() for c in ("seq", "node_id"))
    at = np.arange(rows.num_rows)  # the row that a node's firsts come from
    values = {c: (rows[c].fill_null(0.0).to_numpy(), rows[c].is_valid().to_numpy()) for c in means}
    runs = [[(r["start"], r["end"]) for r in one or []] for one in rows["runs"].to_pylist()] if "runs" in rows.column_names else None
    for _ in range(passes):
        before = np.bincount(image, minlength=len(counts))
        each = before[image]
        a = np.repeat(np.arange(len(image)), each)
        b = np.arange(len(a)) + np.repeat((np.cumsum(before) - before)[image] - (np.cumsum(each) - each), each)
        minr, minc, maxr, maxc = (values[c][0] for c in box)
        known = np.all([values[c][1] for c in box], axis=0)
        met = known[a] & known[b] & _below(minr[a], maxr[b]) & _below(minr[b], maxr[a]) & _below(minc[a], maxc[b]) & _below(minc[b], maxc[a])
        a, b = a[met], b[met]
        # Each node becomes the sum of all that it meets; of these, those of one smallest id become one.
        starts = _begins(a)
        spot = a[starts]
        values = {c: mean(v, b, starts) for c, v in values.items()}
        image, seq, at, runs = image[spot], seq[spot], at[b[starts]], _gathered(runs, b, starts)
        node = np.minimum.reduceat(node[b], starts) if len(starts) else node[:0]
        order = np.lexsort((seq, node, image))
        starts = _begins(image[order], node[order])
        first = order[starts]
        values = {c: mean(v, order, starts) for c, v in values.items()}
        image, seq, at, runs = image[first], seq[first], at[first], _gathered(runs, order, starts)
        node = _numbered(image, node[first], len(counts))
        order = np.lexsort((seq, image))
        stays = (np.bincount(image, minlength=len(counts)) == before)[image[order]]
        done, order = order[stays], order[~stays]
        found = {c: pa.array(x[done], mask=x[done] == LAST) for c, x in (("seq", seq), ("node_id", node))}
        found |= {c: pa.array(x[done], mask=~there[done]) for c, (x, there) in values.items()}
        if runs is not None:
            found["runs"] = pa.array([[{"start": s, "end": e} for s, e in runs[k]] for k in done.tolist()], rows["runs"].type)
            runs = [runs[k] for k in order.tolist()]
        source = pa.array(at[done])
        yield from pa.table([found[c] if c in found else rows[c].take(source) for c in rows.column_names], rows.column_names).to_batches()
        image, seq, at, node = (x[order] for x in (image, seq, at, node))
        values = {c: (x[order], there[order]) for c, (x, there) in values.items()}
        if not len(order):
            return
    raise RuntimeError("a pattern did not settle")


def settled(batches: Iterator[pa.RecordBatch], means: list[str], box: tuple[str, ...], passes: int) -> Iterator[pa.RecordBatch]:
    """Nodes of whole images, sorted by image and seq, with ``_first`` at an image's first, as the nodes of the settled patterns.

    Only a batch and an image that may go on in the next one are held; of these, images with about ``PAIRS`` pairs are merged at once.
    """
    rest = None
    for batch in itertools.chain(batches, [None]):
        rows = pa.concat_tables([t for t in (rest, None if batch is None else pa.Table.from_batches([batch])) if t is not None] or [pa.table({})])
        if not rows.num_rows:
            continue
        rows = rows.combine_chunks()
        starts = np.flatnonzero(rows["_first"].to_numpy())
        ends = starts[1:] if batch is not None else np.append(starts[1:], rows.num_rows)
        starts = starts[: len(ends)]
        counts = ends - starts
        for k in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(np.cumsum(counts**2) // PAIRS)) + 1):
            if len(k):
                yield from settle(rows.slice(starts[k[0]], ends[k[-1]] - starts[k[0]]).drop_columns("_first"), counts[k], means, box, passes)
        rest = rows.slice(ends[-1] if len(ends) else 0)

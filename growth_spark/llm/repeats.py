"""Candidate search that both exact substring operators use: windows that may repeat somewhere, without loss.

A text is a sequence of units (words or bytes), each with a 64-bit code. Of the grams inside each window of L units the
one of least hash (the rightmost, if tied) is the window's anchor: equal windows have equal anchors at equal places, and
about 2 / (L - gram + 2) of all positions are anchors. Neighbouring windows with one anchor form a segment; a window can
repeat only if its anchor does, so segments whose anchor occurs once in the corpus go.

Anchors are counted in one pass and one shuffle. A task compares its own segments first: those whose anchor it holds
twice are candidates at once, whatever the rest of the corpus holds, and are dealt out under salted keys with one marker
a task for the anchor. So an anchor that a third of all documents share sends one row from each task to its place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK, document, map_batches, mix, prefix_hash, window_hash

#: Segments that a task compares with each other before it sends them on.
FLUSH = 500_000
#: Keys that an anchor which repeats within a task is dealt out under.
SALTS = 64
#: Longest window: its places have ten bits in a row.
LONGEST = 1023
SINGLE, KNOWN, MARKER = 0, 1, 2
Units = Callable[[bytes], np.ndarray]


def cut(sizes: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lots of (text, from, to) with some BLOCK units; a longer text goes in parts that overlap by a window."""
    lot, held = [], 0
    for i, size in enumerate(sizes):
        for at in range(0, max(size - window + 1, 0), BLOCK):
            to = min(size, at + BLOCK + window - 1)
            if lot and held + to - at > BLOCK + window:
                yield lot
                lot, held = [], 0
            lot.append((i, at, to))
            held += to - at
    if lot:
        yield lot


def segments(units: np.ndarray, ends: np.ndarray, window: int, gram: int, among: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor's place in the first window, anchor's hash) of the segments of texts laid end to
    end; no window crosses an end, and only windows in ``among`` (a mask) count."""
    hashes = window_hash(prefix_hash(units), gram)
    n = len(units) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    low = np.uint64(0xFFFFF)
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    width, have = window - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:n], least[width - have : width - have + n])
    anchor = (low - (least & low)).astype(np.int64)
    valid = np.ones(n, bool) if among is None else among[:n].copy()
    for e in ends[:-1].tolist():
        valid[max(0, e - window + 1) : e] = False
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    over = np.flatnonzero(new | ~valid)
    first = np.flatnonzero(new)
    stop = np.append(over, n)[np.searchsorted(over, first, side="right")]
    return first, stop - first, anchor[first] - first, hashes[anchor[first]]


def in_ranges(size: int, ranges: list[dict]) -> np.ndarray:
    """Mask of the first units of the windows in ``ranges`` (s, n)."""
    edge = np.zeros(size + 1, np.int64)
    for x in ranges:
        edge[min(x["s"], size)] += 1
        edge[min(x["s"] + x["n"], size)] -= 1
    return np.cumsum(edge[:-1]) > 0


def scan(texts: DataFrame, units: Units, window: int, gram: int, flush: int) -> DataFrame:
    """Segments of ``texts`` (doc, mark, bytes and perhaps open, the ranges of windows that count): (p: the anchor's
    hash, salted, doc, mark, at: place, length, anchor and kind of the row in one number)."""
    ranged = "open" in texts.columns

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            doc, mark = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "mark"))
            for lo in range(0, len(doc), 256):
                coded = [units(t) for t in batch["bytes"].slice(lo, 256).to_pylist()]
                masks = [in_ranges(len(c), x) for c, x in zip(coded, batch["open"].slice(lo, 256).to_pylist(), strict=True)] if ranged else None
                for lot in cut(list(map(len, coded)), window):
                    ends = np.cumsum([to - at for _, at, to in lot])
                    among = np.concatenate([masks[i][at:to] for i, at, to in lot]) if masks else None
                    first, count, place, a = segments(np.concatenate([coded[i][at:to] for i, at, to in lot]), ends, window, gram, among)
                    k = np.searchsorted(ends, first, side="right")
                    shift = np.array([at for _, at, _ in lot]) - (ends - np.array([to - at for _, at, to in lot]))
                    row = lo + np.array([i for i, _, _ in lot])[k]
                    parts.append((a.view(np.int64), doc[row], mark[row], ((first + shift[k]) << 28) | (count << 18) | (place << 8)))
                    held += len(a)
                    if held >= flush:
                        yield from out(parts)
                        parts, held = [], 0
        yield from out(parts)

    def out(parts: list[tuple]) -> Iterator[dict]:
        if not parts:
            return
        a, doc, mark, at = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(a, kind="stable")
        a, doc, mark, at = a[order], doc[order], mark[order], at[order]
        same = a[1:] == a[:-1]
        twice = np.zeros(len(a), bool)
        twice[1:] |= same
        twice[:-1] |= same
        salt = mix((doc * 31 + at).view(np.uint64)).view(np.int64) & (SALTS - 1)
        p = np.where(twice, a ^ (salt << 57), a)
        at = np.where(twice, at | (salt << 2) | KNOWN, at)
        again = np.unique(a[twice])
        none = np.zeros(len(again), np.int64)
        columns = [np.concatenate(c) for c in ((p, again), (doc, none), (mark, none), (at, none + MARKER))]
        for lo in range(0, len(columns[0]), 100_000):
            yield dict(zip(("p", "doc", "mark", "at"), (c[lo : lo + 100_000] for c in columns), strict=True))

    return map_batches(texts, body, "p bigint, doc bigint, mark bigint, at bigint")


def candidates(texts: DataFrame, units: Units, window: int, gram: int, flush: int = FLUSH) -> DataFrame:
    """(doc, mark, s, n, place, a, salt): the segments whose anchor occurs again, windows s … s + n - 1 each."""
    if window > LONGEST:
        raise ValueError(f"windows of more than {LONGEST} units are not supported")
    rows = scan(texts, units, window, gram, flush).withColumn("c", F.count("*").over(Window.partitionBy("p")))
    bits = lambda at, width: F.shiftright("at", at).bitwiseAND((1 << width) - 1)
    rows = rows.withColumn("kind", bits(0, 2)).filter((F.col("kind") == KNOWN) | ((F.col("kind") == SINGLE) & (F.col("c") > 1)))
    rows = rows.withColumn("salt", bits(2, 6))
    return rows.select("doc", "mark", F.shiftright("at", 28).alias("s"), bits(18, 10).alias("n"), bits(8, 10).alias("place"), F.col("p").bitwiseXOR(F.shiftleft("salt", 57)).alias("a"), "salt")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The texts as they are dealt out by document, alike in both joins below: within one plan they are shuffled once."""
    return docs.select(F.col(key).alias("key"), *(c.alias(n) for n, c in document(key, text).items()))


def with_ranges(docs: DataFrame, rows: DataFrame, key: str, text: str, fields: tuple[str, ...] = ("s", "n")) -> DataFrame:
    """Texts that have rows, with these: (doc, mark, key, bytes, open)."""
    lists = rows.groupBy("doc", "mark").agg(F.collect_set(F.struct(*fields)).alias("open"))
    return keyed(docs, key, text).join(lists, ["doc", "mark"])


def with_spans(docs: DataFrame, repeats: DataFrame, key: str, text: str) -> DataFrame:
    """All texts with their repeated windows: (key, null where it was, bytes, spans: array of (s, n), null if none)."""
    lists = repeats.groupBy("doc", "mark").agg(F.collect_set(F.struct("s", "n")).alias("spans"))
    return keyed(docs, key, text).join(lists, ["doc", "mark"], "left").select("key", "bytes", "spans")


def runs(doc: np.ndarray, mark: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows s … s + n - 1 of documents, joined where they touch."""
    order = np.lexsort((s, mark, doc))
    doc, mark, s, to = doc[order], mark[order], s[order], (s + n)[order]
    if not len(doc):
        return doc, mark, s, to
    new = np.ones(len(doc), bool)  # a run that holds the next one whole may end up as two that overlap: no harm
    new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (s[1:] > to[:-1])
    first = np.flatnonzero(new)
    return doc[first], mark[first], s[first], np.maximum.reduceat(to, first) - s[first]


def covered(size: int, spans: list[dict] | None, window: int) -> np.ndarray | None:
    """Which units are in a repeated window; None if there is none."""
    if not spans:
        return None
    edge = np.zeros(size + 1, np.int64)
    s = np.fromiter((x["s"] for x in spans), np.int64, len(spans))
    n = np.fromiter((x["n"] for x in spans), np.int64, len(spans))
    np.add.at(edge, np.minimum(s, size), 1)
    np.add.at(edge, np.minimum(s + n + window - 1, size), -1)
    return np.cumsum(edge[:-1]) > 0

"""Exact byte-substring deduplication by a hash-compared suffix sort.

Segments that may repeat (see ``repeats``) meet in buckets by their anchor. Each bucket is sorted twice by the same
mergesort, in which two suffixes are compared through prefix polynomial hashes, a binary search giving their common
extension in logarithmically many steps:

* the suffixes that begin the segments, as long as the segment. Of segments with equal strings all but the first are
  repeats whole; the first ones stay where the bucket holds others beside them;
* the suffixes that begin the windows of those, as long as a window, apart by their distance to the anchor (equal windows
  have it at equal places). Of equal windows all but the first are repeats.

Neighbours that the hashes find equal are compared byte by byte before anything counts as a repeat. Buckets are sorted
side by side, the steps of all of them being taken at once.

A task drops its own equal segments (compared by their bytes) before it sends them on. An anchor with more than ``MOST``
candidates has its windows dealt out by the hash of the whole window instead, salted in a first round, so neither a
passage that many documents share nor a common phrase in ever other surroundings fills a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, documents, map_batches, powers, prefix_hash, window_hash
from .repeats import FLUSH, SALTS, candidates, covered, runs, with_ranges, with_spans

WINDOW, GRAM = 100, 40
#: Candidates of an anchor that are sorted as they are, and crowded anchors that are broadcast (a megabyte) at most.
MOST, FEW = 2000, 50_000
#: Suffixes that are sorted at a time, whole buckets; bytes of different segments that a task holds to drop equal ones.
LOT, HELD = 1 << 16, 16 << 20
CODES = np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Rows of the buckets: kind DONE are windows known to be repeats, s … s + n - 1; OPEN ones are to be sorted; of CROWDED
#: ones the bucket is the hash of the only window.
DONE, OPEN, CROWDED = 1, 0, 2
DEALT = ("kind", "bucket", "doc", "mark", "s", "n", "place", "data")
SCHEMA = "kind int, bucket bigint, doc bigint, mark bigint, s bigint, n bigint, place bigint, data binary"


def byte_codes(text: bytes) -> np.ndarray:
    return CODES[np.frombuffer(text, np.uint8)]


class Suffixes:
    """Bytes laid end to end, with comparisons of suffixes that end after a size of their own."""

    def __init__(self, data: bytes) -> None:
        self.data = np.frombuffer(data, np.uint8)
        self.prefix = prefix_hash(CODES[self.data])
        self.down = powers(len(data))[1]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length (``most`` at most) of the common extension of suffixes x and y, by binary search over prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), most.copy()
        px, py, dx, dy = self.prefix[x], self.prefix[y], self.down[x], self.down[y]
        for _ in range(int(most.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = (self.prefix[x + mid] - px) * dx == (self.prefix[y + mid] - py) * dy
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix x sorts before y, and whether they are equal; a suffix sorts before what it begins."""
        most = np.minimum(nx, ny)
        n = self.common(x, y, most)
        ended = n >= most
        at = np.where(ended, 0, n)
        return np.where(ended, nx < ny, self.data[x + at] < self.data[y + at]), ended & (nx == ny)

    def sort(self, at: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Order of the suffixes ``at`` within each bucket (buckets are contiguous): mergesort from the bottom up."""
        n = len(at)
        new = np.ones(n, bool)
        new[1:] = bucket[1:] != bucket[:-1]
        base = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        ends = np.append(np.flatnonzero(new)[1:], n)
        end = ends[np.cumsum(new) - 1]
        order = np.arange(n)
        largest = int((end - base).max()) if n else 0
        width = 1
        while width < largest:
            own = np.arange(n) - base
            run = own // width
            lo = np.minimum(base + (run ^ 1) * width, end)
            hi = np.minimum(lo + width, end)
            left = run % 2 == 0
            start = lo.copy()
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_]) >> 1
                a, b = order[mid], order[open_]
                before, equal = self.less(at[a], size[a], at[b], size[b])
                up = before | (equal & ~left[open_])  # equal ones of the left run stay first
                lo[open_[up]] = mid[up] + 1
                hi[open_[~up]] = mid[~up]
            place = base + (run & ~1) * width + own % width + (lo - start)
            merged = np.empty_like(order)
            merged[place] = order
            order = merged
            width *= 2
        return order

    def classes(self, at: np.ndarray, size: np.ndarray, bucket: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Number of the class of equal strings of each suffix in sorted order; equal hashes are verified on the bytes."""
        s, n, b = at[order], size[order], bucket[order]
        new = np.ones(len(s), bool)
        same = np.flatnonzero((b[1:] == b[:-1]) & (n[1:] == n[:-1]))
        equal = same[self.common(s[same], s[same + 1], n[same]) >= n[same]]
        for lo in range(0, len(equal), 1 << 13):  # some megabytes at a time
            part = equal[lo : lo + (1 << 13)]
            ends = np.cumsum(n[part])
            inside = np.arange(ends[-1]) - np.repeat(ends - n[part], n[part])
            differ = self.data[np.repeat(s[part], n[part]) + inside] != self.data[np.repeat(s[part + 1], n[part]) + inside]
            new[part + 1] = np.add.reduceat(differ, ends - n[part]) > 0
        return np.cumsum(new) - 1


def later_ones(order: np.ndarray, kind: np.ndarray, doc: np.ndarray, mark: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Which suffixes repeat an earlier one of their class: of a document of smaller key, or earlier in the same document."""
    by = np.lexsort((s[order], mark[order], doc[order], kind))
    rows, k = order[by], kind[by]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    d, m, p = doc[rows], mark[rows], s[rows]
    same = np.zeros(len(k), bool)
    same[1:] = ~new[1:] & (d[1:] == d[:-1]) & (m[1:] == m[:-1])
    at_start = np.maximum.accumulate(np.where(same, 0, np.arange(len(k)))) if len(k) else first
    gone = np.zeros(len(k), bool)
    gone[rows] = (d != d[first]) | (same & (p > p[at_start]))
    return gone


def sort_rows(rows: list[tuple], window: int) -> tuple[tuple[np.ndarray, ...], list[int]]:
    """Runs of repeated windows (doc, mark, s, n) of rows (bucket, doc, mark, s, n, place, data), in order of bucket; and
    the numbers of the rows that are the first of equal segments."""
    bucket, doc, mark, s, n, place = (np.array(c, np.int64) for c in zip(*(r[:6] for r in rows), strict=True))
    sizes = n + window - 1
    sorter = Suffixes(b"".join(r[6] for r in rows))
    offset = np.cumsum(sizes) - sizes
    order = sorter.sort(offset, sizes, bucket)
    kind = sorter.classes(offset, sizes, bucket, order)
    gone = later_ones(order, kind, doc, mark, s)
    # Firsts of classes whose bucket holds another class have their windows sorted.
    new = np.concatenate([[True], kind[1:] != kind[:-1]])
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    several = np.repeat(np.add.reduceat(new.astype(np.int64), start) > 1, np.diff(np.append(start, len(bucket))))
    left = np.flatnonzero(~gone & several)
    k = np.repeat(left, n[left])
    inside = np.arange(len(k)) - np.repeat(np.cumsum(n[left]) - n[left], n[left])
    apart = np.lexsort((place[k] - inside, bucket[k]))
    k, inside = k[apart], inside[apart]
    group = np.zeros(len(k), np.int64)
    group[1:] = np.cumsum((bucket[k[1:]] != bucket[k[:-1]]) | ((place[k] - inside)[1:] != (place[k] - inside)[:-1]))
    at, length = offset[k] + inside, np.full(len(k), window)
    order = sorter.sort(at, length, group)
    later = later_ones(order, sorter.classes(at, length, group, order), doc[k], mark[k], s[k] + inside)
    whole = np.flatnonzero(gone)
    found = [np.concatenate(c) for c in ((doc[whole], doc[k][later]), (mark[whole], mark[k][later]), (s[whole], (s[k] + inside)[later]), (n[whole], np.ones(later.sum(), np.int64)))]
    return runs(*found), np.flatnonzero(~gone).tolist()


def deal(texts: DataFrame, window: int) -> DataFrame:
    """Candidate segments with their bytes, by bucket (DEALT); those of crowded anchors window by window."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        lot: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, mark, text, ranges in zip(batch["doc"].to_pylist(), batch["mark"].to_pylist(), batch["bytes"], batch["open"], strict=True):
                data = text.as_py()
                for x in ranges.as_py():
                    s, n = x["s"], x["n"]
                    lot.append((CROWDED if x["crowded"] else OPEN, x["a"], doc, mark, s, n, x["place"], data[s : s + n + window - 1]))
                    held += n + window
                if held >= HELD:
                    yield from out(lot)
                    lot, held = [], 0
        yield from out(lot)

    def out(lot: list[tuple]) -> Iterator[dict]:
        """Equal segments first, then the windows of the crowded ones that are left."""
        done, left = apart(lot)
        windows: list[tuple] = []
        for kind, _, doc, mark, s, n, _, data in left:
            if kind == CROWDED:
                hashes = window_hash(prefix_hash(byte_codes(data)), window).view(np.int64).tolist()
                windows += [(CROWDED, h, doc, mark, s + i, 1, 0, data[i : i + window]) for i, h in enumerate(hashes)]
        more, single = apart(windows)
        joined = runs(*(np.array(c, np.int64) for c in zip(*((r[2], r[3], r[4], r[5]) for r in done + more), strict=True))) if done or more else ()
        rows = [(DONE, d * 31 + x & 0x7FFFFFFFFFFFFFFF, d, m, x, k, 0, b"") for d, m, x, k in zip(*(c.tolist() for c in joined), strict=True)]
        rows += [r for r in left if r[0] == OPEN] + single
        for lo in range(0, len(rows), 4096):
            yield dict(zip(DEALT, map(list, zip(*rows[lo : lo + 4096], strict=True)), strict=True))

    def apart(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """Rows that are later than one of the same bucket and bytes, and the others."""
        known: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for _, bucket, doc, mark, s, _, _, data in rows:
            at = (doc, mark, s)
            if (have := known.get((bucket, data))) is None or at < have:
                known[bucket, data] = at
        done, left = [], []
        for row in rows:
            d, m, p = known[row[1], row[7]]
            (done if row[2] != d or (row[3] == m and row[4] > p) else left).append(row)
        return done, left

    return map_batches(texts, body, SCHEMA)


def sort_buckets(dealt: DataFrame, window: int) -> DataFrame:
    """The rows of ``dealt`` judged: repeats found (kind DONE), and of CROWDED ones the firsts, to be dealt again."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        rows: list[tuple] = []
        last, held = None, 0
        for batch in batches:
            passed: list[tuple] = []
            for kind, key, row in zip(batch["kind"].to_pylist(), batch["_bucket"].to_pylist(), zip(*(batch[c].to_pylist() for c in DEALT[1:]), strict=True), strict=True):
                if kind == DONE:
                    passed.append(row)
                    continue
                if held >= LOT and key != last:
                    yield done(rows)
                    rows, held = [], 0
                rows.append((kind, key, row))
                last, held = key, held + row[4]
            if passed:
                yield {"kind": [DONE] * len(passed)} | dict(zip(DEALT[1:], map(list, zip(*passed, strict=True)), strict=True))
        if rows:
            yield done(rows)

    def done(rows: list[tuple]) -> dict:
        (doc, mark, s, n), first = sort_rows([(key, *row[1:]) for _, key, row in rows], window)
        again = [rows[i][2] for i in first if rows[i][0] == CROWDED]
        none = [0] * len(doc)
        found = (none, doc.tolist(), mark.tolist(), s.tolist(), n.tolist(), none, [b""] * len(doc))
        return {"kind": [DONE] * len(doc) + [CROWDED] * len(again)} | {c: v + [r[i] for r in again] for i, (c, v) in enumerate(zip(DEALT[1:], found, strict=True))}

    alone = F.count("*").over(Window.partitionBy("_bucket"))
    met = dealt.withColumn("_alone", alone).filter((F.col("_alone") > 1) | (F.col("kind") != OPEN)).sortWithinPartitions("_bucket")
    return map_batches(met.select("kind", "_bucket", *DEALT[1:]), body, SCHEMA)


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, most: int = MOST, flush: int = FLUSH, few: int = FEW) -> DataFrame:
    """Windows of ``window`` bytes that also start earlier (smaller key, or earlier in the same text): (doc, mark, s, n)."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    found = scratch.save(candidates(documents(docs, key, text), byte_codes, window, min(gram, window), flush), "candidates")
    crowded = scratch.save(found.groupBy("a").agg(F.count("*").alias("c")).filter(F.col("c") > most).select("a", F.lit(True).alias("crowded")), "crowded")
    if crowded.count() <= few:
        marked = found.join(F.broadcast(crowded), "a", "left")
    else:  # too many to send to all: dealt out under the salts that their candidates have
        salted = crowded.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        marked = found.join(salted, ["a", "salt"], "left")
    marked = marked.withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    dealt = deal(with_ranges(docs, marked, key, text, ("a", "s", "n", "place", "crowded")), window)
    # Salted by document, each copy of a crowded window meets few others; what is left of each salt meets in a second round.
    salt = F.shiftleft(F.pmod(F.xxhash64("doc", "mark"), F.lit(SALTS)), 57)
    keyed = dealt.withColumn("_bucket", F.when(F.col("kind") == CROWDED, F.col("bucket").bitwiseXOR(salt)).otherwise(F.col("bucket")))
    first = scratch.save(sort_buckets(keyed, window), "sorted")
    again = first.filter(F.col("kind") == CROWDED).withColumn("_bucket", F.col("bucket"))
    second = scratch.save(sort_buckets(again, window), "again")
    scratch.drop("candidates", "crowded")
    both = first.unionByName(second).filter(F.col("kind") == DONE)
    return both.select("doc", "mark", "s", "n")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: key, kept (the remaining bytes, concatenated), n_bytes, n_removed and n_spans (maximal removed runs).

    ``key`` is an integer; null keys come after all others. Each row is judged by its own text, also where a key is null
    or repeated: of rows of one key none is earlier than the other, so what only they share stays (rows alike in key and
    text are one document). Null texts are empty; other columns are not read.
    """

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {key: batch["key"], "kept": [], "n_bytes": [], "n_removed": [], "n_spans": []}
            for data, spans in zip(batch["bytes"], batch["spans"], strict=True):
                text = data.as_py()
                gone = covered(len(text), spans.as_py(), window)
                out["kept"].append(text if gone is None else np.frombuffer(text, np.uint8)[~gone].tobytes())
                out["n_bytes"].append(len(text))
                out["n_removed"].append(0 if gone is None else int(gone.sum()))
                out["n_spans"].append(0 if gone is None else int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            yield out

    rows = with_spans(docs, repeated_windows(docs, key, text, window), key, text)
    return map_batches(rows, body, f"{key} {rows.schema['key'].dataType.simpleString()}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")

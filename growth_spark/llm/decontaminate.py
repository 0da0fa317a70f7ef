"""Benchmark decontamination: a broadcast hash set of benchmark windows is looked up along every document.

The benchmark's windows are collected only after their number has been checked against ``most``, the proven bound of
what is broadcast; a larger benchmark is taken in as many parts as it needs, each within the bound, and the hit words
of the parts are united by numbers of the rows. Documents are scanned once per part, without any shuffle when one part
is enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, groups, map_batches, prefix_hash, window_hash, with_binary

#: Words a window has; items with fewer words are one window of all their words.
WINDOW = 13
#: Bytes of benchmark text, and so words at most, that are broadcast at a time (some 100 MB at most).
MOST_WORDS = 2_000_000
LOT = 1 << 18
#: Lower-cases A-Z; ASCII that is neither a letter nor a digit becomes a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Grams:
    """Windows of the benchmark: word numbers, window hashes by length, and the items each window occurs in."""

    def __init__(self, items: list[tuple[int, bytes]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        texts, windows = [], {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            if ids:
                texts.append((item, np.array(ids, np.int64)))
        rng = np.random.default_rng(13)
        self.code = rng.integers(1, 1 << 63, len(self.number) + 1, dtype=np.uint64)
        self.code[0] = 0  # a word that no item has
        for item, ids in texts:
            n = min(window, len(ids))
            hashes = window_hash(prefix_hash(self.code[ids]), n)
            for at, h in enumerate(hashes.tolist()):
                windows.setdefault(n, {}).setdefault(h, {}).setdefault(ids[at : at + n].tobytes(), set()).add(item)
        self.lengths = {n: (np.array(sorted(by), np.uint64), by) for n, by in windows.items()}

    def scan(self, lots: list[list[bytes]]) -> Iterator[tuple[np.ndarray, set]]:
        """Per text: the positions of its hit words, and the items that have an occurring window."""
        sizes = np.array([len(x) for x in lots], np.int64)
        ends = np.cumsum(sizes)
        get = self.number.get
        ids = np.fromiter((get(w, 0) for lot in lots for w in lot), np.int64, int(ends[-1]) if len(ends) else 0)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        prefix = prefix_hash(self.code[ids])
        hits: list[list[int]] = [[] for _ in lots]
        found: list[set] = [set() for _ in lots]
        for n, (hashes, by) in self.lengths.items():
            starts = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else np.zeros(0, np.int64)
            owner = np.searchsorted(ends, starts, side="right")
            starts = starts[starts + n <= ends[owner]] if len(starts) else starts
            h = window_hash(prefix, n, at=starts)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for p, x in zip(*(v[hashes[at] == h].tolist() for v in (starts, h)), strict=True):
                if items := by[x].get(ids[p : p + n].tobytes()):  # verified word by word
                    k = int(np.searchsorted(ends, p, side="right"))
                    hits[k].extend(range(p, p + n))
                    found[k] |= items
        for k in range(len(lots)):
            yield np.unique(np.array(hits[k], np.int64)) - (ends[k] - sizes[k]), found[k]


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", window: int = WINDOW, most: int = MOST_WORDS) -> DataFrame:
    """Per document: n_words, hits (positions of hit words) and items (ids of items with an occurring window).

    Null texts have no words; an empty benchmark hits nothing. Repeated documents each give a row. Other columns are
    not read. Windows never cross documents.
    """
    items = with_binary(benchmark, item).filter(F.length("bytes") > 0)
    rows = with_binary(docs, key)
    kinds = rows.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    total = items.agg(F.sum(F.length("bytes"))).first()[0] or 0
    spark = docs.sparkSession

    def lookup(own: DataFrame, rows: DataFrame, ids: str, kind: str) -> tuple[DataFrame, Broadcast]:
        """``rows`` looked up in the windows of the items ``own``; their columns ``ids`` stay."""
        shared = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in own.distinct().collect()])

        def body(batches: Iterator[dict]) -> Iterator[dict]:
            grams = Grams(shared.value, window)
            for batch in batches:
                texts = batch["bytes"].to_pylist()
                out: dict = {ids: batch[ids], "n_words": [], "hits": [], "items": []}
                for a, b in groups(list(map(len, texts)), LOT):
                    lots = [words(t) for t in texts[a:b]]
                    out["n_words"] += map(len, lots)
                    for hits, found in grams.scan(lots):
                        out["hits"].append(hits.tolist())
                        out["items"].append(sorted(found, key=lambda x: (x is None, x)))
                yield out

        return map_batches(rows, body, f"{ids} {kind}, n_words bigint, hits array<bigint>, items array<{kinds[1]}>"), shared

    if total <= most:
        return lookup(items, rows, key, kinds[0])[0]
    # Several parts: rows get numbers that are written once, and the parts' hits are united by them.
    scratch = Scratch(spark, "contamination")
    numbered = scratch.save(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    cut = scratch.save(in_parts(items, item, window, most), "items")
    made = []
    for k, group in enumerate(packed(cut, most)):
        own = cut.join(F.broadcast(spark.createDataFrame(group, "_bucket bigint, _share bigint")), ["_bucket", "_share"]).select(item, "bytes")
        found, shared = lookup(own, numbered.select("_row", "bytes"), "_row", "bigint")
        made.append(scratch.save(found if k == 0 else found.filter(F.size("hits") > 0), f"part{k}"))
        shared.destroy()
    united = reduce(DataFrame.unionByName, made).groupBy("_row", "n_words")
    united = united.agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return numbered.select("_row", key).join(united, "_row").select(key, "n_words", "hits", "items")


def pieces(text: bytes, window: int, most: int) -> Iterator[bytes]:
    """``text`` in pieces of at most ``most`` bytes (or of ``window`` words, if these are longer) that have the same windows."""
    if len(text) <= most:
        yield text
        return
    all_words = words(text)
    start = 0
    while True:
        end, size = start, 0
        while end < len(all_words) and (end - start < window or size + len(all_words[end]) < most):
            size += len(all_words[end]) + 1
            end += 1
        yield b" ".join(all_words[start:end])
        if end == len(all_words):
            return
        start = end - window + 1


def in_parts(items: DataFrame, item: str, window: int, most: int) -> DataFrame:
    """Items, the long ones in pieces, with the bucket and the share of it (``_bucket``, ``_share``) that they are in.

    Pieces have at most half of ``most`` bytes, and those of a share begin within one such half of the bucket's running
    size; so a share has at most ``most`` bytes.
    """
    half = max(most // 2, 1)

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for i, text in enumerate(batch["bytes"].to_pylist()):
                cut = list(pieces(text, window, half))
                yield {item: pa.concat_arrays([batch[item].slice(i, 1)] * len(cut)), "bytes": cut}

    kind = items.schema[item].dataType.simpleString()
    cut = map_batches(items.distinct(), body, f"{item} {kind}, bytes binary")
    total = cut.agg(F.sum(F.length("bytes")).alias("_total"))
    spread = cut.join(F.broadcast(total)).withColumn("_hash", F.xxhash64(item, "bytes")).withColumn("_bucket", F.pmod("_hash", F.ceil(F.col("_total") / most)))
    before = F.sum(F.length("bytes")).over(Window.partitionBy("_bucket").orderBy("_hash", item, "bytes").rowsBetween(Window.unboundedPreceding, 0)) - F.length("bytes")
    return spread.withColumn("_share", F.floor(before / half)).select(item, "bytes", "_bucket", "_share")


def packed(cut: DataFrame, most: int) -> list[list[tuple[int, int]]]:
    """Shares in groups of at most ``most`` bytes; a larger share (of words longer than that) is a group alone."""
    sizes = cut.groupBy("_bucket", "_share").agg(F.sum(F.length("bytes")).alias("n")).orderBy("_bucket", "_share").collect()
    return [[(r["_bucket"], r["_share"]) for r in sizes[a:b]] for a, b in groups([r["n"] for r in sizes], most)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", share: int = 20, most: int = MOST_WORDS) -> DataFrame:
    """``docs`` without the documents of which at least one word in ``share`` is hit; all columns and rows else stay.

    Each row is judged by its own text, whether its key is null or repeated: rows go by 128 bits of hash of key and text.
    """
    mark = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(i), F.col(key), F.col("text"))) for i in (1, 2)])
    found = contamination(docs.select(mark.alias("_mark"), "text"), benchmark, "_mark", most=most)
    bad = found.filter((F.size("hits") > 0) & (F.size("hits") * share >= F.col("n_words"))).select(F.col("_mark").alias("_bad")).distinct()
    return docs.join(bad, mark == F.col("_bad"), "left_anti")


def item_digest(ids: list) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()

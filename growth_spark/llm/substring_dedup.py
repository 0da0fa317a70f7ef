"""Substring deduplication by level-wise doubling.

Windows are looked for at a short length first. Those that repeat at one length, and only those, are extended to twice
that length (the last level takes what remains to the full one), until the full length is reached or no candidate
survives. Below the full length each window stands in for its neighbourhood by a minimum hash (see ``repeats``); at the
full length every surviving window is compared by a 128-bit hash. A word goes if a window around it also starts in a
document of smaller key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, Scratch, documents, map_batches, prefix_hash, window_hash
from .repeats import FLUSH, candidates, covered, in_ranges, runs, with_ranges, with_spans

#: Words of a window, and of the windows of the first level.
WINDOW, SHORTEST = 50, 25
OTHER = 0xD6E8FEB86659FD93


def word_codes(text: bytes) -> np.ndarray:
    parts = text.split()  # bytes are split at exactly the six ASCII white-space characters
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths by doubling, the last one ``window``."""
    lengths = [min(shortest, window)]
    while lengths[-1] < window:
        lengths.append(min(2 * lengths[-1], window))
    return lengths


def full_windows(texts: DataFrame, window: int, flush: int) -> DataFrame:
    """The surviving windows at full length: (kind, h1, h2, doc, mark, s, n). Kind 1 are repeats of a document of
    smaller key that the same task holds, joined to runs; the others (kind 0, n = 1) are still to be compared."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, mark, text, ranges in zip(batch["doc"].to_pylist(), batch["mark"].to_pylist(), batch["bytes"], batch["open"], strict=True):
                codes = word_codes(text.as_py())
                at = np.flatnonzero(in_ranges(len(codes), ranges.as_py()))
                at = at[at + window <= len(codes)]
                parts.append((*(window_hash(prefix_hash(codes, base), window, base, at).view(np.int64) for base in (BASE, OTHER)), np.full(len(at), doc, np.int64), np.full(len(at), mark, np.int64), at))
                held += len(at)
                if held >= flush:
                    yield from out(parts)
                    parts, held = [], 0
        yield from out(parts)

    def out(parts: list[tuple]) -> Iterator[dict]:
        if not parts:
            return
        h1, h2, doc, mark, s = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, mark, s = (c[order] for c in (h1, h2, doc, mark, s))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        later = doc != doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(new) else new
        gone = runs(doc[later], mark[later], s[later], np.ones(later.sum(), np.int64))
        spread = gone[2] * 31 + gone[1]
        for kind, columns in ((1, (spread, spread, *gone)), (0, (*(c[~later] for c in (h1, h2, doc, mark, s)), np.ones((~later).sum(), np.int64)))):
            for lo in range(0, len(columns[0]), 100_000):
                part = [c[lo : lo + 100_000] for c in columns]
                yield {"kind": np.full(len(part[0]), kind, np.int32)} | dict(zip(("h1", "h2", "doc", "mark", "s", "n"), part, strict=True))

    return map_batches(texts, body, "kind int, h1 bigint, h2 bigint, doc bigint, mark bigint, s bigint, n bigint")


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, shortest: int = SHORTEST, flush: int = FLUSH) -> DataFrame:
    """Windows of ``window`` words (of at least 2) that also start in a document of smaller key: (doc, mark, s, n)."""
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = documents(docs, key, text)
    for length in levels(window, shortest)[:-1]:
        found = scratch.save(candidates(texts, word_codes, window, length, flush).select("doc", "mark", "s", "n"), f"level{length}")
        if found.isEmpty():
            return found
        texts = with_ranges(docs, found, key, text)
    if "open" not in texts.columns:  # a window as short as the first level
        texts = texts.withColumn("open", F.array(F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(1 << 40).cast("bigint").alias("n"))))
    # A task sends one document's rows for a window at most, so one shuffle brings a window's rows together safely.
    first = F.min("doc").over(Window.partitionBy("h1", "h2"))
    # They are not written: so the plan that joins them to the texts has these in it twice, and shuffles them once.
    judged = full_windows(texts, window, flush).withColumn("first", first).filter("kind = 1 OR doc > first")
    return judged.select("doc", "mark", "s", "n")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: key, text (the kept words, joined by one blank), n_words and n_removed.

    ``key`` is an integer; null keys come after all others. Each row is judged by its own text, also where a key is null
    or repeated: rows of one key are none of them smaller than the other, so what only they share stays. Null texts have
    no words; other columns are not read.
    """

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {key: batch["key"], "text": [], "n_words": [], "n_removed": []}
            for data, spans in zip(batch["bytes"], batch["spans"], strict=True):
                parts = data.as_py().split()
                gone = covered(len(parts), spans.as_py(), window)
                kept = parts if gone is None else [w for w, x in zip(parts, gone.tolist(), strict=True) if not x]
                out["text"].append(b" ".join(kept).decode())
                out["n_words"].append(len(parts))
                out["n_removed"].append(len(parts) - len(kept))
            yield out

    rows = with_spans(docs, repeated_windows(docs, key, text, window), key, text)
    return map_batches(rows, body, f"{key} {rows.schema['key'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint")

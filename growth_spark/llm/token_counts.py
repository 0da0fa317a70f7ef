"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

Pre-tokens that a worker has not met yet are laid end to end in one ragged array of symbols. Each round finds, in
every sequence at once, the pair of lowest rank, applies it at all its places from the left, and lets sequences
without any further pair go; the symbols that survive are the tokens. A pair that a merge makes has a higher rank than
the merge itself, so taking all places of the lowest pair together gives what one merge at a time gives.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import Memory, groups, map_batches, with_binary

#: Bytes of text that are split into pre-tokens at a time.
LOT = 2 << 20
NONE = np.iinfo(np.int32).max
#: Marks a part that can't be counted alone.
ODD = 1 << 50


class Merges:
    """The merge table of a tokenizer file as sorted arrays, and the special strings that it knows."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # The printable characters stand for their own byte; the other bytes follow from 256 on, in order.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        glyph = {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}
        vocabulary = spec["model"]["vocab"]
        self.byte = np.array([vocabulary[glyph[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True))) if special else None
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """The number of symbols that each byte string keeps once no pair can be merged."""
        counts = np.ones(len(tokens), np.int64)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        owner = np.arange(len(tokens))  # of the sequences that are still being merged
        symbols = self.byte[np.frombuffer(b"".join(tokens), np.uint8)]
        row = np.repeat(owner, sizes)
        ranks = np.full(len(symbols), NONE, np.int32)
        inside = np.flatnonzero(row[1:] == row[:-1])
        ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        while len(owner):
            best = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
            over = best == NONE
            counts[owner[over]] = sizes[over]
            hit = np.flatnonzero((ranks == best[row]) & (ranks != NONE))
            # In a run of overlapping places (a a a) every second one is taken, from the left.
            new = np.ones(len(hit), bool)
            new[1:] = hit[1:] != hit[:-1] + 1
            first = np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            keep = ~over[row]
            keep[hit + 1] = False
            place = np.cumsum(keep)[hit] - 1
            renumber = np.cumsum(~over) - 1
            row, symbols, ranks = renumber[row[keep]], symbols[keep], ranks[keep]
            owner = owner[~over]
            sizes = np.bincount(row, minlength=len(owner))
            # Only pairs that touch a new symbol have another rank than before.
            touched = np.concatenate([place, place[place > 0] - 1])
            last = np.minimum(touched + 1, len(symbols) - 1)
            whole = (touched < len(symbols) - 1) & (row[touched] == row[last])
            ranks[touched] = np.where(whole, self.rank(symbols[touched], symbols[last]), NONE)
        return counts

    def learn(self, chunks: list[str]) -> list[int]:
        """Tokens in each chunk, by way of its pre-tokens."""
        lots = list(map(self.split, chunks))
        new = {t for lot in lots for t in lot}
        count = dict(zip(new, self.count([t.encode("utf-8") for t in new]).tolist(), strict=True)) if new else {}
        return [sum(map(count.__getitem__, lot)) for lot in lots]

    def texts(self, texts: list[str], memory: Memory) -> list[int]:
        """Tokens in each text; a special string inside a text counts as one token.

        A blank that a non-blank follows always starts a pre-token, so a text's count is the sum over its parts
        between blanks, each with the blank before it; parts that begin with white space (or are empty) send their
        text the plain way.
        """
        lots = [t.split(" ") for t in texts]
        heads = [lot.pop(0) for lot in lots]
        new = dict.fromkeys(set().union(*lots).difference(memory.known), ODD)
        fit = [c for c in new if c and not c[0].isspace() and not (self.special and self.special.search(c))]
        new.update(zip(fit, self.learn([" " + c for c in fit]), strict=True))
        plain = [not h or h[0].isspace() or bool(self.special and self.special.search(h)) for h in heads]
        first = self.learn(["" if odd else h for odd, h in zip(plain, heads, strict=True)])
        with memory.room(new) as known:
            counts = [ODD if odd else n + sum(map(known.__getitem__, lot)) for odd, n, lot in zip(plain, first, lots, strict=True)]
        if again := [i for i, n in enumerate(counts) if n >= ODD]:
            pieces = [self.special.split(texts[i]) if self.special else [texts[i]] for i in again]
            each = iter(self.learn([p for lot in pieces for p in lot]))
            for i, lot in zip(again, pieces, strict=True):
                counts[i] = len(lot) - 1 + sum(next(each) for _ in lot)
        return counts


_MERGES: dict[str, Merges] = {}


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """Per row of ``docs``: ``key``, n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null texts count as empty and have no tokens. Repeated rows each give a row, an empty table none; other columns of
    ``docs`` are not read. One pass, no shuffle. ``path`` names a byte-level BPE file of the tokenizers library.
    """

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        merges, memory = _MERGES.get(path) or _MERGES.setdefault(path, Merges(path)), Memory()
        for batch in batches:
            texts = batch["bytes"].to_pylist()
            sizes = list(map(len, texts))
            counts: list[int] = []
            for a, b in groups(sizes, LOT):
                counts += merges.texts([t.decode("utf-8") for t in texts[a:b]], memory)
            yield {key: batch[key], "n_bytes": sizes, "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    rows = with_binary(docs, key, text)
    return map_batches(rows, body, f"{key} {rows.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")

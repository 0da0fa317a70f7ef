"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from the model file alone, each with explicit states and arcs:

* the normaliser reads characters and writes characters: a trie of the model's rewriting rules (longest match first, any
  other character for itself), blanks written as U+2581 and, where the model asks for it, runs of blanks as one, none at
  the ends, and a blank before the text;
* the pieces are a trie whose final states write a piece's number at the piece's weight; user-defined pieces are arcs that
  the normaliser leaves alone;
* the fallback reads one character that no piece consists of and writes one number a byte (or the unknown one).

Composed with an input (many inputs at once: their characters lie in one array, and every position is a start that walks
the trie one arc at a time), they give a lattice of arcs from position to position. Its shortest path in the tropical
semiring (min, +) is the encoding, found column by column. For a unigram model an arc costs the negative score of its
piece. For a model of type BPE piece scores are priorities and no costs: there the state at a position is the piece read
last, and the arc from piece a to piece b costs nothing if merging the characters of ab by the priorities leaves exactly
a, b, and is infinite otherwise. A sequence of pieces is what merging gives exactly if each neighbouring pair is, so at
each position one state has a finite cost. The output side run backwards is the decoder.

A text falls into parts before blanks that are encoded alone (pieces never hold U+2581 after another character; models
where one does are encoded whole). What a task has encoded it remembers within a bound in bytes, until it ends.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, groups, map_batches, mix

BLANK = "▁"
INFINITE = float("inf")
#: States of a position: no path arrives, the first position, and after a fallback or user-defined arc.
NO, START = -1, (1 << 20) - 1
#: Positions that are composed at once, and bytes of texts taken at a time.
LOT, TEXTS = 1 << 16, 1 << 20
RUNS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|[\s_]|\w").findall
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Trie:
    """A deterministic automaton over characters: arcs (state, symbol) to state, sorted; final states have an output."""

    def __init__(self, words: dict[str, int]) -> None:
        arcs: dict[tuple[int, int], int] = {}
        final = [-1]
        for word, out in words.items():
            state = 0
            for c in map(ord, word):
                nxt = arcs.get((state, c))
                if nxt is None:
                    nxt = arcs[state, c] = len(final)
                    final.append(-1)
                state = nxt
            final[state] = out
        keys = np.array([(s << 21) | c for s, c in arcs], np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(arcs.values(), np.int64, len(arcs))[order]
        self.final = np.array(final, np.int64)
        self.root = np.full(0x110000, -1, np.int32)  # the first arcs by symbol: most walks take no other
        for (s, c), nxt in arcs.items():
            if s == 0:
                self.root[c] = nxt

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        key = (states << 21) | symbols
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1) if len(self.keys) else np.full(len(states), -1)


class Normaliser:
    """The rewriting transducer of a model: ``rules`` from source to target, and what it does with blanks."""

    def __init__(self, rules: dict[str, str], user: list[str], prefix: bool, strip: bool, escape: bool) -> None:
        self.rules = {**rules, **{u: u for u in user}}
        self.prefix, self.strip, self.blank = prefix, strip, BLANK if escape else " "
        firsts = {k[0] for k in self.rules}
        self.first = re.compile("[" + "".join(map(re.escape, sorted(firsts))) + "]") if firsts else None
        self.longest = max(map(len, self.rules), default=0)
        self.kept = set(user)

    def written(self, text: str) -> Iterator[str]:
        """What the arcs write, rule by rule: the longest that matches, or the characters themselves."""
        at = 0
        while at < len(text):
            m = self.first.search(text, at) if self.first else None
            if m is None:
                yield text[at:]
                return
            if m.start() > at:
                yield text[at : m.start()]
            at = m.start()
            size = next((n for n in range(min(self.longest, len(text) - at), 0, -1) if text[at : at + n] in self.kept), 0)
            size = size or next((n for n in range(min(self.longest, len(text) - at), 0, -1) if text[at : at + n] in self.rules), 0)
            yield self.rules[text[at : at + size]] if size else text[at]
            at += size or 1

    def apply(self, text: str) -> str:
        out = "".join(self.written(text))
        if self.strip:
            out = re.sub(" +", " ", out).strip(" ")
        if not (out if self.strip else text):
            return ""
        return (self.blank if self.prefix else "") + out.replace(" ", self.blank)


def charsmap(blob: bytes) -> dict[str, str]:
    """Rules of a compiled character map: a double array (32-bit units: label, offset, whether a value follows) over the
    sources' UTF-8 bytes, and the targets, each ended by a zero byte."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
    targets = blob[4 + size :]
    offset = (units >> 10) << ((units & (1 << 9)) >> 6)
    label = units & ((1 << 31) | 0xFF)
    rules: dict[str, str] = {}
    todo = [(int(offset[0]), b"")]
    each = np.arange(1, 256)
    while todo:
        node, source = todo.pop()
        place = node ^ each
        inside = place < len(units)
        for c in each[inside][label[place[inside]] == each[inside]].tolist():
            child = node ^ c
            below = child ^ int(offset[child])
            key = source + bytes([c])
            if (int(units[child]) >> 8) & 1:
                start = int(units[below]) & 0x7FFFFFFF
                rules[key.decode()] = targets[start : targets.index(b"\0", start)].decode()
            todo.append((below, key))
    return rules


class Transducer:
    """The compiled model."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        self.bpe = proto.trainer_spec.model_type == 2
        if proto.trainer_spec.model_type not in (1, 2) or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with blanks before words are supported")
        if self.bpe and any(p.type == UNUSED for p in proto.pieces):
            raise ValueError("BPE models with unused pieces are not supported")
        kinds = {i: p for i, p in enumerate(proto.pieces)}
        self.user = {p.piece: i for i, p in kinds.items() if p.type == USER_DEFINED}
        norm = proto.normalizer_spec
        self.normal = Normaliser(charsmap(norm.precompiled_charsmap), list(self.user), norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces)
        self.id = {p.piece: i for i, p in kinds.items() if p.type == NORMAL}
        self.score = {p.piece: p.score for p in kinds.values() if p.type == NORMAL}
        self.unknown = next(i for i, p in kinds.items() if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in kinds.items() if p.type == BYTE} if proto.trainer_spec.byte_fallback else {}
        self.out = [bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE else b" \xe2\x81\x87 " if p.type == UNKNOWN else b"" if p.type == CONTROL else p.piece.replace(BLANK, " ").encode() for p in proto.pieces]
        self.piece = {i: p for p, i in (self.id | self.user).items()}
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(self.user, key=len, reverse=True))) + ")") if self.user else None
        # Pieces that merging never makes of their own characters can be on no path of a BPE model.
        arcs = {p: i for p, i in self.id.items() if not self.bpe or self.merged(p) == [p]}
        if not self.bpe:
            arcs |= self.user
        self.trie = Trie(arcs)
        best = max(self.score.values(), default=0.0)
        self.weight = np.zeros(len(proto.pieces), np.float32)
        for p, i in arcs.items():
            self.weight[i] = 0 if self.bpe else -(len(p.encode()) * np.float32(best) - np.float32(0.1)) if p in self.user else -np.float32(self.score[p])
        self.dear = np.float32(10.0 - min(self.score.values(), default=0.0))  # of a fallback arc
        self.seams = {a + b for p in self.id for a, b in pairwise(p)}
        self.apart = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.id) and not self.normal.rules
        self.pair_key, self.pair_fits = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def merged(self, text: str) -> list[str]:
        """The characters of a short string, merged by priority, leftmost first."""
        parts, get = list(text), self.score.get
        scores = [get(a + b, -INFINITE) for a, b in pairwise(parts)]
        while scores and (most := max(scores)) > -INFINITE:
            at = scores.index(most)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], -INFINITE)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], -INFINITE)
        return parts

    def lattice(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Composition with inputs laid end to end, each ended by 0: arcs (start, end, piece; -1 for the fallback)."""
        start = np.flatnonzero(chars)
        state = self.trie.root[chars[start]].astype(np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lone = start[self.trie.final[np.maximum(state, 0)] < 0] if len(self.trie.keys) else start
        found.append((lone, lone + 1, np.full(len(lone), -1)))
        length = 0
        while True:
            on = state >= 0
            start, state, length = start[on], state[on], length + 1
            if not len(start):
                break
            final = self.trie.final[state]
            ends = np.flatnonzero(final >= 0)
            found.append((start[ends], start[ends] + length, final[ends]))
            state = self.trie.step(state, chars[start + length])  # no arc reads the 0 at an end
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def compose(self, parts: list[str]) -> list[bytes]:
        """Numbers written on the shortest path of each normalised input, column by column of all inputs at once."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        base = np.cumsum(sizes + 1) - (sizes + 1)
        chars = np.frombuffer(("\0".join(parts) + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
        start, end, piece = self.lattice(chars)
        column = end - np.repeat(base, sizes + 1)[start]
        order = np.lexsort((start, end, column))  # of arcs to one place the longest first
        start, end, piece, column = start[order], end[order], piece[order], column[order]
        cost = np.full(len(chars), np.inf, np.float32)
        cost[base] = 0
        state, back = np.full(len(chars), NO, np.int64), np.full(len(chars), -1, np.int64)
        state[base] = START
        bounds = np.searchsorted(column, np.arange(1, int(sizes.max(initial=0)) + 2))
        for lo, hi in pairwise(bounds.tolist()):
            s, e, p = start[lo:hi], end[lo:hi], piece[lo:hi]
            first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
            stop = np.append(first[1:], len(e))
            if self.bpe:  # costs are 0 or infinite: the first finite one is least, so no more arcs than needed are weighed
                hit = np.zeros(0, np.int64)
                while len(first):
                    fits = (state[s[first]] != NO) & self.fit(state[s[first]], p[first])
                    hit = np.append(hit, first[fits])
                    first, stop = first[~fits] + 1, stop[~fits]
                    first, stop = first[first < stop], stop[first < stop]
                cost[e[hit]] = 0
            else:
                total = cost[s] + np.where(p < 0, self.dear, self.weight[p])
                least = np.minimum.reduceat(total, first)
                hit = np.flatnonzero(total == np.repeat(least, stop - first))[::-1]  # the longest of equal arcs is written last
                cost[e[hit]] = total[hit]
            back[e[hit]], state[e[hit]] = s[hit], np.where(p[hit] < 0, START, p[hit])
        return self.written(chars, base, sizes, state, back)

    def written(self, chars: np.ndarray, base: np.ndarray, sizes: np.ndarray, state: np.ndarray, back: np.ndarray) -> list[bytes]:
        """The outputs on the paths, followed back from every input's end."""
        at, rows = base + sizes, np.arange(len(base))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows := rows[at[rows] > base[rows]]):
            steps.append((rows, at[rows]))
            at[rows] = back[at[rows]]
        if not steps:
            return [b""] * len(base)
        row, place = (np.concatenate(c[::-1]) for c in zip(*steps, strict=True))
        order = np.argsort(row, kind="stable")
        row, ids = row[order], state[place[order]].astype(np.int32)
        ends = np.searchsorted(row, np.arange(len(base) + 1))
        odd = np.unique(row[ids == START])
        data = ids.tobytes()
        out = [data[4 * a : 4 * b] for a, b in pairwise(ends.tolist())]
        for r in odd.tolist():
            numbers: list[int] = []
            for i, p in zip(ids[ends[r] : ends[r + 1]].tolist(), place[order][ends[r] : ends[r + 1]].tolist(), strict=True):
                if i != START:
                    numbers.append(i)
                elif self.bytes:
                    numbers += [self.bytes[b] for b in chr(int(chars[p - 1])).encode()]
                else:
                    numbers.append(self.unknown)
            out[r] = array("i", numbers).tobytes()
        return out

    def fit(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """BPE: whether the arc of ``piece`` may follow ``last``, from the table of pairs met before or else by merging."""
        key = (last << 20) | piece
        slot = (mix(key.astype(np.uint64)) & np.uint64(len(self.pair_key) - 1)).astype(np.int64)
        free = (last == START) | (last == NO) | (piece < 0)
        ok = self.pair_fits[slot] | free
        if len(unmet := np.flatnonzero((self.pair_key[slot] != key) & ~free)):
            pairs, first, each = np.unique(key[unmet], return_index=True, return_inverse=True)
            words = ((self.piece[k >> 20], self.piece[k & 0xFFFFF]) for k in pairs.tolist())
            fits = np.fromiter((a[-1] + b[0] not in self.seams or self.merged(a + b) == [a, b] for a, b in words), bool, len(pairs))
            ok[unmet] = fits[each]
            at = slot[unmet[first]]
            self.pair_key[at], self.pair_fits[at] = pairs, fits
        return ok

    def cut(self, text: str) -> list[str]:
        """Normalised ``text`` in runs of like characters, joined again where some piece holds both characters at the
        seam; no piece crosses from one to the next."""
        if not self.bpe:
            return [text]
        runs = RUNS(text)
        out = runs[:1]
        for x in runs[1:]:
            if out[-1][-1] + x[0] in self.seams:
                out[-1] += x
            else:
                out.append(x)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Numbers of normalised texts, by way of their runs, each encoded once."""
        lots: list[list[str | int]] = []
        for t in texts:
            lot: list[str | int] = []
            for k, x in enumerate(self.splits.split(t) if self.splits and self.bpe else [t]):
                lot += [self.user[x]] if k % 2 else self.cut(x) if x else []
            lots.append(lot)
        new = sorted({x for lot in lots for x in lot if isinstance(x, str)}, key=len)
        known: dict[str | int, bytes] = {i: array("i", [i]).tobytes() for i in self.user.values()}
        for a, b in groups([len(x) + 1 for x in new], LOT):
            known.update(zip(new[a:b], self.compose(new[a:b]), strict=True))
        return [b"".join(map(known.__getitem__, lot)) for lot in lots]

    def texts(self, texts: list[str], memory: Memory) -> list[bytes]:
        """Numbers of the pieces of each text as 32-bit integers in a byte string."""
        norm = self.normal
        lots: list[list[str] | None] = []
        whole: list[str] = []
        for t in texts:
            plain = self.apart and norm.prefix and not self.user and t and "  " not in t and t[0] != " " and t[-1] != " " and BLANK not in t
            lots.append(t.split(" ") if plain else None)  # parts, each with the blank before it
            if not plain:
                whole.append(norm.apply(t))
        new = list(set().union(*(lot for lot in lots if lot)).difference(memory.known))
        with memory.room(dict(zip(new, self.encode([norm.blank + p for p in new]), strict=True))) as known:
            pieces = [re.findall(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", t) if self.apart and not self.user else [t] for t in whole]
            parts = list(dict.fromkeys(p for lot in pieces for p in lot))
            odd = dict(zip(parts, self.encode(parts), strict=True))
            each = iter(pieces)
            found = [b"".join(map(known.__getitem__, lot)) if lot is not None else b"".join(map(odd.__getitem__, next(each))) for lot in lots]
        return found if self.bytes else [self.as_one(x) for x in found]

    def as_one(self, ids: bytes) -> bytes:
        """Unknown characters that follow one another make one piece."""
        x = np.frombuffer(ids, np.int32)
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != self.unknown) | (x[:-1] != self.unknown)
        return x[keep].tobytes()

    def decode(self, ids: array) -> str:
        """The text whose encoding ``ids`` are; the dummy blank goes, bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.normal.prefix and text[:1] == " " else text


_MODELS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    return _MODELS.get(path) or _MODELS.setdefault(path, Transducer(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ids (numbers of its pieces); null texts count as empty and have none. One pass, no shuffle."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        model, memory = transducer(path), Memory()
        for batch in batches:
            texts = batch["_text"].to_pylist()
            ids = [x for a, b in groups(list(map(len, texts)), TEXTS) for x in model.texts(texts[a:b], memory)]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int64)
            if ends[-1] >= 1 << 31:  # Arrow lists have 32-bit offsets
                for i, x in enumerate(ids):
                    yield {key: batch[key].slice(i, 1), "ids": [array("i", x).tolist()]}
                continue
            yield {key: batch[key], "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))}

    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return map_batches(rows, body, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key and text; null ids count as none."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        model = transducer(path)
        for batch in batches:
            yield {key: batch[key], "text": [model.decode(array("i", x or [])) for x in batch[ids].to_pylist()]}

    return map_batches(rows.select(key, ids), body, f"{key} {rows.schema[key].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_ids, ids_sha256 (of the little-endian 32-bit numbers), n_bytes of the decoded text, its
    text_sha256, and same (decoding gives the text back; false only where the text itself holds U+2581 or the normaliser
    rewrites it). Null texts count as empty. Encoding and decoding share a pass, so the numbers are never shuffled."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        model, memory = transducer(path), Memory()
        for batch in batches:
            out: dict = {key: batch[key], "n_ids": [], "ids_sha256": [], "n_bytes": [], "text_sha256": [], "same": []}
            texts = batch["_text"].to_pylist()
            each = ((t, x) for a, b in groups(list(map(len, texts)), TEXTS) for t, x in zip(texts[a:b], model.texts(texts[a:b], memory), strict=True))
            for t, ids in each:
                back = model.decode(array("i", ids))
                data = back.encode()
                for column, value in zip(("n_ids", "ids_sha256", "n_bytes", "text_sha256", "same"), (len(ids) // 4, hashlib.sha256(ids).hexdigest(), len(data), hashlib.sha256(data).hexdigest(), back == t), strict=True):
                    out[column].append(value)
            yield out

    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return map_batches(rows, body, f"{key} {rows.schema[key].dataType.simpleString()}, n_ids bigint, ids_sha256 string, n_bytes bigint, text_sha256 string, same boolean")

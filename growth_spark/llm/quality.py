"""Quality rules per document, and a verdict per host shrunk by an empirical beta prior.

Counts are made in one pass over whole texts and kept as a small table. Failures are summed by host (a partial sum in
each task, so a host with a third of all rows is no burden), and the hosts' rates give a beta prior by its moments. With
it each host's rate has a posterior of its own. A host falls if that says, at the level ``LEVEL``, that the odds of a
failure are more than ``ODDS`` times those of the prior mean; the verdict is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, groups, map_batches, prefix_hash, window_hash

SYMBOLS = b"#*$%&|<>"
#: A host falls when the odds of its failures are surely more than so many times the common ones, and how sure (in
#: standard deviations of the posterior; 2.326 is 99 %). Documents of other hosts are judged by the base alone.
ODDS, LEVEL = 2.0, 2.326
LOT = 1 << 18
_OTHER = bytes(b for b in range(256) if b not in SYMBOLS)
_FOLLOW = bytes(range(128, 192)) + b" \t\n\r\x0b\x0c"  # bytes that start no code point of a word


def counts(text: bytes) -> tuple[int, int, int, int]:
    """n_words, word_chars, n_symbols and n_dup_lines of one text."""
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n") if b"\n" in text else ():
        if line in seen:
            again += 1
        elif line and not line.isspace():
            seen.add(line)
    return len(text.split()), len(text.translate(None, _FOLLOW)), len(text.translate(None, _OTHER)), again


def repeated_words(lots: list[list[bytes]], window: int = 5) -> np.ndarray:
    """Per text: words in windows of ``window`` words that occur twice or more in the text."""
    sizes = np.array([len(x) for x in lots], np.int64)
    out = np.zeros(len(lots), np.int64)
    if not sizes.sum():
        return out
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for lot in lots for w in lot), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(lots)), sizes)
    if len(ids) < window:
        return out
    starts = np.flatnonzero(owner[: len(ids) - window + 1] == owner[window - 1 :])
    codes = np.random.default_rng(5).integers(1, 1 << 63, len(number), dtype=np.uint64)
    # One hash for text and window together; equal hashes are then compared word by word with their neighbour.
    h = window_hash(prefix_hash(codes[ids]), window, at=starts) + owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(h, kind="stable")
    s = starts[order]
    equal = h[order][1:] == h[order][:-1]
    for k in range(window):
        equal &= ids[s[1:] + k] == ids[s[:-1] + k]
    equal &= owner[s[1:]] == owner[s[:-1]]
    twice = np.zeros(len(s) + 1, bool)
    twice[1:-1] |= equal
    again = np.zeros(len(ids) + 1, np.int64)
    hit = s[twice[:-1] | twice[1:]]
    np.add.at(again, hit, 1)
    np.add.at(again, hit + window, -1)
    covered = np.cumsum(again[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(lots)).astype(np.int64)


def rule_counts(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Per document: key, host and the base counts with base_failed. Null texts have no words and fail."""
    rows = docs.select(F.col(key), F.col(host), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = batch["bytes"].to_pylist()
            out = list(zip(*map(counts, texts), strict=True))
            again = np.concatenate([repeated_words([t.split() for t in texts[a:b]]) for a, b in groups(list(map(len, texts)), LOT)])
            n = np.array(out[0], np.int64)
            yield {key: batch[key], host: batch[host], "n_words": n, "word_chars": out[1], "n_symbols": out[2], "n_dup_lines": out[3], "n_repeat_words": again, "base_failed": (n < 10) | (100 * again > 20 * n)}

    kinds = (f"{c} {rows.schema[c].dataType.simpleString()}" for c in (key, host))
    return map_batches(rows, body, f"{', '.join(kinds)}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean")


def failures() -> dict[str, F.Column]:
    """The rules whose failures are summed by host: symbol share, word length, repeated lines, and the base."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (chars < 2 * n) | (chars > 15 * n),
        "lines": 5 * F.col("n_dup_lines") > n,
        "base": F.col("base_failed"),
    }


def host_verdicts(rules: DataFrame, host: str = "source", odds: float = ODDS, level: float = LEVEL) -> DataFrame:
    """Per host: n_docs, n_failed, shrunken rate (the posterior mean) and host_failed.

    The beta prior is fitted to all hosts' rates by moments (mean m, variance v: a + b = m(1-m)/v - 1, within 1 and
    1000; a lone host or equal rates give 1000). Null hosts make one host of their own.
    """
    failed = F.lit(False)
    for rule in failures().values():
        failed = failed | rule
    hosts = rules.groupBy(host).agg(F.count("*").alias("n_docs"), F.sum(failed.cast("long")).alias("n_failed"))
    share = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(share).alias("m"), F.var_pop(share).alias("v"))
    weight = F.least(F.greatest(F.coalesce(F.try_divide(F.col("m") * (1 - F.col("m")), F.col("v")) - 1, F.lit(1000.0)), F.lit(1.0)), F.lit(1000.0))
    prior = moments.select(F.col("m"), weight.alias("w"))  # one row
    shrunken = (F.col("n_failed") + F.col("m") * F.col("w")) / (F.col("n_docs") + F.col("w"))
    rated = hosts.join(F.broadcast(prior)).withColumn("rate", shrunken)
    least = F.col("rate") - level * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n_docs") + F.col("w") + 1))
    common = odds * F.col("m") / (1 + (odds - 1) * F.col("m"))
    return rated.select(host, "n_docs", "n_failed", "rate", (least > common).alias("host_failed"))


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", odds: float = ODDS, level: float = LEVEL) -> DataFrame:
    """Base counts of every document with its host's shrunken rate, host_failed and kept.

    ``kept`` is false if the base rules fail or the host's verdict does. Repeated rows each give a row; an empty table
    gives none; other columns of ``docs`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rules = scratch.save(rule_counts(docs, key, host, text), "rules")
    hosts = host_verdicts(rules, host, odds, level).select(F.col(host).alias("_host"), "rate", "host_failed")
    joined = rules.join(hosts, rules[host].eqNullSafe(hosts["_host"]), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False)))

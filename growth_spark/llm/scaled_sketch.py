"""Document fingerprints by threshold-scaled sketches.

A text's set is its distinct five-word shingles (A-Z lower-cased; all its words if they are fewer), each a 64-bit hash.
The sketch keeps every hash below a fixed fraction of the range. It grows with its text, so sketches of a very short and
a very long document can be compared: what the sketches share estimates what the sets share. Sketches merge by union, and
the sketch of a union of texts' sets is the union of their sketches.

The fingerprint is a string: a digest of the whole set, its size, and the retained hashes in order, cut to 48 bits, as base64.
So equal texts have equal fingerprints, and texts too short to have a retained hash are still told apart. The likeness of
two fingerprints is 1 where the digests are equal, else the estimated containment of the smaller set in the other
(0 without retained hashes); the estimated Jaccard similarity stands beside it.

* Null texts are empty ones. An empty text or one without words has the empty set; two of them are alike.
* ``edited`` compares each document with its edited text and with the next document. Documents are in the order of
  their integer key, those without key last; rows of one key in the order of a hash of their texts; repeated rows are
  documents of their own, next to each other. The last document is followed by the first, a single one by itself.
* An empty table gives no row. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, key_of, map_batches
from .near_dedup import shingles

#: The sketch keeps hashes below 1 / 2**KEPT_BITS of the range; a fingerprint shows CUT_BITS of each.
KEPT_BITS, CUT_BITS = 2, 48
#: Bytes of text that are held as Python objects at a time.
LOT = 1 << 21


class Sketch(NamedTuple):
    """Digest and size of a text's set, and its retained hashes, sorted."""

    digest: int
    size: int
    kept: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Sketch:
        every = shingles(text).view(np.uint64)
        kept = np.sort(every[every < np.uint64(1 << (64 - KEPT_BITS))] >> np.uint64(64 - KEPT_BITS - CUT_BITS))
        return cls(xxhash.xxh3_64_intdigest(every.tobytes()), len(every), kept)

    def written(self) -> str:
        body = self.kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - CUT_BITS // 8 :]
        return f"{self.digest:016x}:{self.size}:{base64.b64encode(body.tobytes()).decode()}"

    @classmethod
    def read(cls, fingerprint: str) -> Sketch:
        digest, size, body = fingerprint.split(":")
        cut = np.frombuffer(base64.b64decode(body), np.uint8).reshape(-1, CUT_BITS // 8)
        return cls(int(digest, 16), int(size), np.pad(cut, ((0, 0), (8 - CUT_BITS // 8, 0))).view(">u8").reshape(-1).astype(np.uint64))


def merged(a: Sketch, b: Sketch) -> np.ndarray:
    """Retained hashes of the union of two sets."""
    return np.union1d(a.kept, b.kept)


def contained(a: Sketch, b: Sketch) -> float:
    """Estimate of the share of ``a``'s set that ``b``'s has too."""
    if a.digest == b.digest and a.size == b.size:
        return 1.0
    return float(len(np.intersect1d(a.kept, b.kept, assume_unique=True)) / len(a.kept)) if len(a.kept) else 0.0


def likeness(a: Sketch, b: Sketch) -> tuple[float, float]:
    """(containment of the smaller in the larger, Jaccard similarity), estimated."""
    if a.digest == b.digest and a.size == b.size:
        return 1.0, 1.0
    both = len(np.intersect1d(a.kept, b.kept, assume_unique=True))
    least = min(len(a.kept), len(b.kept))
    return (both / least, both / (len(a.kept) + len(b.kept) - both)) if least else (0.0, 0.0)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of each row's whole text; no shuffle."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for a, b in groups([len(t.as_buffer()) for t in batch["bytes"]], LOT):
                yield {key: batch["key"][a:b], "fingerprint": [Sketch.of(t).written() for t in batch["bytes"][a:b].to_pylist()]}

    return map_batches(rows, body, f"{key} {dict(docs.dtypes)[key]}, fingerprint string")


def followed(docs: DataFrame, key: str, text: str, parts: int | None = None) -> DataFrame:
    """Rows (key, bytes, extra) in tasks, in order, such that each document is followed by the next one.

    The range of keys is cut at quantiles; each part ends with a copy of the document that the next part begins with
    (``extra``). So the texts are shuffled once, and one text a part is copied.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(key_of(key).alias("_doc"))
    cuts = sorted(set(keys.select(F.col("_doc").cast("double").alias("_doc")).approxQuantile("_doc", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    # A key in the part at whose lower end it lies; the same double gives the same part.
    bucket = Bucketizer(splits=[float("-inf"), *cuts, float("inf")] if cuts else [float("-inf"), 0.0, float("inf")], inputCol="_at", outputCol="_bucket")

    def placed(df: DataFrame) -> DataFrame:
        return bucket.transform(df.withColumn("_at", F.col("_doc").cast("double"))).withColumn("_part", F.col("_bucket").cast("int")).drop("_at", "_bucket")

    # The least key of each part: as many rows as parts.
    least = sorted((r["_part"], r["_doc"]) for r in placed(keys).groupBy("_part").agg(F.min("_doc").alias("_doc")).collect())
    rows = docs.select(F.col(key).alias("key"), key_of(key).alias("_doc"), F.xxhash64(text).alias("_mark"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    before = spark.createDataFrame([(doc, least[i - 1][0]) for i, (_, doc) in enumerate(least)], "_doc bigint, _part int")
    first = rows.join(F.broadcast(before), "_doc").groupBy("_part").agg(F.min_by(F.struct("bytes"), F.struct("_mark", "bytes")).alias("_first"))
    heads = first.select(F.lit(None).cast(dict(rows.dtypes)["key"]).alias("key"), F.lit(None).cast("bigint").alias("_doc"), F.lit(None).cast("bigint").alias("_mark"), F.col("_first.bytes").alias("bytes"), "_part", F.lit(True).alias("extra"))
    both = placed(rows).select("key", "_doc", "_mark", "bytes", "_part", F.lit(False).alias("extra")).unionByName(heads)
    return both.repartitionById(len(cuts) + 2, "_part").sortWithinPartitions("_part", "extra", "_doc", "_mark", "bytes").select("key", "bytes", "extra")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """A row for each document: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    jaccard_edited, jaccard_next, n_shingles. The edited text has its last half (floor) replaced by the first as many code
    points of the next document, or all of them."""

    def row(own: tuple, after: str, next_: Sketch) -> tuple:
        key_, whole, sketch = own
        half = len(whole) // 2
        changed = (whole[: len(whole) - half] + after[:half]).encode("utf-8", "surrogateescape")
        other = Sketch.of(changed)
        (near_edited, jaccard_edited), (near_next, jaccard_next) = likeness(sketch, other), likeness(sketch, next_)
        return key_, len(whole), hashlib.sha256(changed).hexdigest(), sketch.written(), other.written(), near_edited, near_next, jaccard_edited, jaccard_next, sketch.size

    names = (key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "jaccard_edited", "jaccard_next", "n_shingles")

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        held = None
        for batch in batches:
            for a, b in groups([len(t.as_buffer()) for t in batch["bytes"]], LOT):
                made = []
                for k, data, extra in zip(*(batch[c][a:b].to_pylist() for c in ("key", "bytes", "extra")), strict=True):
                    this, sketch = data.decode("utf-8", "surrogateescape"), Sketch.of(data)
                    if held is not None:
                        made.append(row(held, this, sketch))
                    held = None if extra else (k, this, sketch)
                if made:
                    yield dict(zip(names, map(list, zip(*made, strict=True)), strict=True))

    return map_batches(followed(docs, key, text, parts), body, f"{key} {dict(docs.dtypes)[key]}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double, jaccard_next double, n_shingles bigint")

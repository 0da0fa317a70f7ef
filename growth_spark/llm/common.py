"""Helpers that several corpus operators share: scratch tables, Arrow mapping, polynomial hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multiplier of the polynomial hashes (mod 2**64, so that it has an inverse).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Positions that one numpy block may hold; longer texts are cut into overlapping blocks.
BLOCK = 1 << 19


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only where the session names none and runs locally."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return path or _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="spark-"))


_OWN: dict[str, str] = {}


class Scratch:
    """Parquet tables in the shared checkpoint folder: they cut lineage and survive the loss of executors.

    A table that no later step reads may be dropped; the last ones stay, as the query's rows are read from them.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, body: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``body`` over each partition; it takes and gives dictionaries of column lists, Arrow carries them."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = _parse_datatype_string(schema)
    assert isinstance(out, StructType)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (dict(zip(b.schema.names, b.columns, strict=True)) for b in batches if b.num_rows)
        for made in body(columns):
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, t.type) for v, t in ((made[t.name], t) for t in arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, out)


def groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about ``most`` at most; one larger row makes a range alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes in place so that their order is random (a bijection)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


class Memory:
    """What a task has worked out for parts of texts, within a bound of bytes; one object a task, gone when it ends.

    Parts of more than ``LONG`` characters are not kept. A memory that is full starts afresh.
    """

    LONG = 48

    def __init__(self, most: int = 48 << 20) -> None:
        self.most, self.size, self.known = most, 0, {}

    @contextmanager
    def room(self, new: dict) -> Iterator[dict]:
        """All that is known and ``new``, while the block runs; afterwards as much as may be kept."""
        known = self.known
        known.update(new)
        yield known
        self.size += sum(250 if len(k) <= self.LONG else 0 for k in new)
        if self.size > self.most:
            self.known, self.size = {}, 0
        else:
            for k in [k for k in new if len(k) > self.LONG]:
                del known[k]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse for i up to n, mod 2**64; a worker keeps 2 * BLOCK of each (16 MB a base) at most."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        inverse = pow(base, -1, 1 << 64)
        most = max(n + 1, 1 << 16)
        up, down = np.full(most, base, np.uint64), np.full(most, inverse, np.uint64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if most <= 2 * BLOCK:
            _POWERS[base] = have
    return have[0][: n + 1], have[1][: n + 1]


def prefix_hash(units: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums of the polynomial hash of ``units`` (uint64), of length n + 1."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units), base)[0][: len(units)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, length: int, base: int = BASE, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows of ``length`` units, at all starts or at those in ``at``."""
    down = powers(len(prefix), base)[1]
    if at is None:
        n = len(prefix) - length
        return mix((prefix[length:] - prefix[:n]) * down[:n]) if n > 0 else np.zeros(0, np.uint64)
    return mix((prefix[at + length] - prefix[at]) * down[at])


#: Stands for a null key: such documents come after all others.
LAST = (1 << 63) - 1


def key_of(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint"), F.lit(LAST))


def mark_of(key: str, text: str) -> Column:
    """Tells rows of one key apart: rows alike in key and text are one document, others are not."""
    return F.xxhash64(F.lit(42), F.col(key), F.col(text))


def document(key: str, text: str) -> dict[str, Column]:
    """What the operators on repeats and copies know a row by (doc, mark), and its bytes (null as empty)."""
    return {"doc": key_of(key), "mark": mark_of(key, text), "bytes": F.coalesce(F.col(text), F.lit("")).cast("binary")}


def documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(*(c.alias(n) for n, c in document(key, text).items()))


def with_binary(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The key and the text's UTF-8 bytes only, null as empty."""
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))

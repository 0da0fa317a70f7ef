"""Frame chunks kept by (data_id, chunk_idx): written aside, then committed; of a chunk pushed again the last version stands.

A version is a folder of Parquet files with the frames themselves; a manifest with the version's number says that the folder
is whole. Readers see committed versions only, so a write that breaks off leaves nothing behind that counts, and one that is
run again (a batch of a stream after a restart) replaces its own version.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.chunks import chunk_key, frame_shape

if TYPE_CHECKING:
    import pandas as pd

KEY = ("data_id", "chunk_idx")
ROW = "data_id string, chunk_idx int, key string, dims string, frames binary, start_unix_ms_utc bigint, end_unix_ms_utc bigint"


def shape(dims: Column) -> Column:
    """(n, height, width) of a chunk; a rank other than two or three is an error of the job that reads it."""
    message = F.concat(F.lit("frames must have two or three dimensions, not "), F.coalesce(dims, F.lit("none")))
    return F.coalesce(frame_shape(dims), F.raise_error(message).cast("array<int>"))


def checked(rows: DataFrame) -> DataFrame:
    """Chunks (data_id, chunk_idx, dims, frames, start_unix_ms_utc, fps) ready to be stored. Frames are bytes, one a pixel: a
    number of them that the shape doesn't ask for is an error, as is a missing key."""
    made = rows.withColumn("_s", shape(F.col("dims")))
    pixels = F.col("_s")[0].cast("bigint") * F.col("_s")[1] * F.col("_s")[2]
    whole = F.when(F.octet_length("frames") == pixels, F.col("frames")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("frames of"), "data_id", F.lit("don't fill"), "dims")).cast("binary"))
    keyed = [F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"{c} is missing")).cast(kind)).alias(c) for c, kind in zip(KEY, ("string", "int"), strict=True)]
    end = F.col("start_unix_ms_utc") + (F.col("_s")[0] / F.col("fps") * 1000).cast("bigint")
    return made.select(*keyed, chunk_key(F.col("chunk_idx")).alias("key"), F.array_join(F.transform("_s", lambda x: x.cast("string")), ",").alias("dims"), whole.alias("frames"), "start_unix_ms_utc", end.alias("end_unix_ms_utc"))


class ChunkStore:
    """Chunks under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the committed versions: one file name each."""
        jvm, fs = self._fs()
        manifests = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(manifests)) if fs.exists(manifests) else []

    def write(self, rows: DataFrame, version: int) -> None:
        """``rows`` as the version of this number, in place of what it held. Of equal keys in ``rows`` any one is kept."""
        jvm, fs = self._fs()
        manifest = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{version}")
        fs.delete(manifest, False)  # while it is written anew, it doesn't count
        checked(rows).write.mode("overwrite").parquet(f"{self.path}/versions/{version}")
        fs.mkdirs(manifest.getParent())
        fs.create(manifest, True).close()

    def push(self, rows: DataFrame) -> int:
        """``rows`` as a new last version; its number."""
        version = max(self.versions(), default=-1) + 1
        self.write(rows, version)
        return version

    def sink(self, first: int = 0):
        """For ``foreachBatch``: each batch is a version, so one that is run again replaces itself. ``first`` is the number
        of the first batch's version; later pushes come after those of the stream."""
        return lambda batch, number: self.write(batch, first + number)

    def read(self) -> DataFrame:
        """One row a chunk, the last version's: only keys and versions are shuffled, frames are read where they stand."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], f"{ROW}, version bigint")
        each = [self.spark.read.schema(ROW).parquet(f"{self.path}/versions/{v}").withColumn("version", F.lit(v).cast("bigint")) for v in known]
        rows = each[0]
        for more in each[1:]:
            rows = rows.unionByName(more)
        rows = rows.withColumn("_row", F.struct("version", F.monotonically_increasing_id()))
        last = rows.groupBy(*KEY).agg(F.max("_row").alias("_row"))
        return rows.join(last, [*KEY, "_row"], "left_semi").drop("_row")

    def compact(self) -> None:
        """All versions as one, under the last one's number; the others go once that one is committed."""
        known = self.versions()
        if len(known) < 2:
            return
        jvm, fs = self._fs()
        merged = known[-1] + 1
        self.read().drop("version").write.mode("overwrite").parquet(f"{self.path}/versions/{merged}")
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{merged}"), True).close()
        for v in known:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{v}"), False)
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{v}"), True)


class Numbering(StatefulProcessor):
    """The next chunk's number of each stream."""

    def __init__(self, order: list[str]) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        import pandas as pd

        start = self.next.get()[0] if self.next.exists() else 0
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        self.next.update((start + len(batch),))
        yield batch.assign(chunk_idx=range(start, start + len(batch)))

    def close(self) -> None:
        pass


def numbered(stream: DataFrame, order: list[str]) -> DataFrame:
    """A stream of chunks without numbers (data_id and ``order``), numbered from 0 by data_id over all batches.

    Only keys go through the state, so number the rows' keys and join the frames by them, or stream keys alone."""
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in stream.schema.fields)}, chunk_idx int"
    return stream.groupBy("data_id").transformWithStateInPandas(Numbering(order), schema, "Update", "None")

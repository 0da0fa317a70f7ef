"""Frame streams: settings, chunks and life cycle as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import chunk_end_ms, chunk_key, chunk_size_ok, dims, frames_per_rotation, is_rotating, stream_name

ACTIVE, INTERRUPTED, FINALIZING, ERROR, SUCCESS = "stream_active", "stream_interrupted", "stream_finalizing", "stream_error", "success"


def opened(requests: DataFrame, now: Column) -> DataFrame:
    """Rows of the streams table from requests (data_id, name, fps, rpm, chunk_size, sample_name); a chunk of less than
    two seconds raises."""
    size = F.when(chunk_size_ok(F.col("chunk_size"), F.col("fps")), F.col("chunk_size")).otherwise(F.raise_error(F.lit("chunk_size holds less than two seconds of frames")).cast("int"))
    return requests.select("data_id", stream_name(F.col("name"), now).alias("data_item_name"), frames_per_rotation(F.col("fps"), F.col("rpm")).alias("rotational_period"), F.col("rpm").alias("rotations_per_min"), F.col("fps").alias("fps_capture_rate"), size.alias("chunk_size"), is_rotating(F.col("rpm")).alias("is_rotating"), "sample_name", F.lit(ACTIVE).alias("status"))


def link_samples(streams: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(streams with physical_sample_id, samples with those created for unknown names).

    Names match without regard to case and outer blanks; the sample of smallest id wins; blank names link to none.
    """
    name = F.nullif(F.lower(F.trim("sample_name")), F.lit(""))
    known = samples.groupBy(F.lower(F.trim("name")).alias("_key")).agg(F.min("id").alias("physical_sample_id"))
    wanted = streams.withColumn("_key", name)
    new = wanted.filter("_key IS NOT NULL").join(known, "_key", "left_anti").groupBy("_key").agg(F.min(F.trim("sample_name")).alias("name"))
    created = new.select("_key", "name", F.sha2("_key", 256).alias("id"))
    everyone = known.unionByName(created.select("_key", F.col("id").alias("physical_sample_id")))
    return wanted.join(everyone, "_key", "left").drop("_key"), samples.select("id", "name").unionByName(created.select("id", "name"))


def chunks(frames: DataFrame, streams: DataFrame) -> DataFrame:
    """Chunk rows from frames (data_id, frame_number, height, width, start_ms): numbered from 0, each of at most
    chunk_size frames, with its end time, key and dims."""
    rows = frames.join(streams.select("data_id", "chunk_size", "fps_capture_rate"), "data_id")
    order = F.col("frame_number") - F.min("frame_number").over(Window.partitionBy("data_id"))
    rows = rows.withColumn("chunk_idx", F.floor(order / F.col("chunk_size")).cast("int"))
    grouped = rows.groupBy("data_id", "chunk_idx").agg(F.count("*").alias("n"), F.max("height").alias("h"), F.max("width").alias("w"), F.min("start_ms").alias("start_unix_ms_utc"), F.first("fps_capture_rate").alias("fps"))
    return grouped.select("data_id", "chunk_idx", chunk_key(F.col("chunk_idx")).alias("key"), dims(F.col("n"), F.col("h"), F.col("w")).alias("dims"), "start_unix_ms_utc", chunk_end_ms(F.col("start_unix_ms_utc"), F.col("n"), F.col("fps")).alias("end_unix_ms_utc"))


def latest(pushed: DataFrame) -> DataFrame:
    """One row a chunk: of chunks pushed again under one index the last (by ``pushed_at``) stands."""
    order = Window.partitionBy("data_id", "chunk_idx").orderBy(F.desc("pushed_at"))
    return pushed.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def append_batch(path: str):
    """A ``foreachBatch`` sink: each batch goes to a partition of its own, so a batch that is run again replaces itself."""

    def write(df: DataFrame, number: int) -> None:
        df.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return write


def finalized(streams: DataFrame, ids: list[str]) -> DataFrame:
    """Streams closed; closing one that is closed already changes nothing."""
    return streams.withColumn("status", F.when(F.col("data_id").isin(ids) & F.col("status").isin(ACTIVE, INTERRUPTED), F.lit(FINALIZING)).otherwise(F.col("status")))

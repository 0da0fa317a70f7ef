"""File intake and export manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chunks import PART_BYTES, parts


def intake(spark: SparkSession, path: str, part: int = PART_BYTES) -> DataFrame:
    """Parts of the files at ``path`` (path, part, offset, size); only their lengths are read. A missing file raises."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return parts(files, part).select("path", "part", "offset", "size")


def completion(done: DataFrame) -> DataFrame:
    """Per upload, its parts with their tags in order of number."""
    return done.groupBy("upload_id").agg(F.array_sort(F.collect_list(F.struct("part", "etag"))).alias("parts"))


def export_names(files: DataFrame, processed: bool = False) -> DataFrame:
    """Name of each exported file: its own, or its id with the format (mp4 if unknown)."""
    name = F.coalesce("file_name", F.concat(F.col("data_id").cast("string"), F.lit("."), F.coalesce("file_format", F.lit("mp4"))))
    return files.select("data_id", F.lit("processed" if processed else "raw").alias("kind"), name.alias("name"))

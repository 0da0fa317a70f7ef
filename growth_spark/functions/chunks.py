"""Frame chunks, streams and files: the small rules of their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BYTES = 40 << 20


def frames_per_rotation(fps: Column, rpm: Column) -> Column:
    """Null when stationary."""
    return F.try_divide(fps * 60, rpm)


def is_rotating(rpm: Column) -> Column:
    return rpm > 0


def chunk_size_ok(chunk_size: Column, fps: Column) -> Column:
    """A chunk holds at least two seconds of frames."""
    return chunk_size >= F.ceil(fps * 2)


def chunk_end_ms(start_ms: Column, frames: Column, fps: Column) -> Column:
    return start_ms + (frames / fps * 1000).cast("bigint")


def chunk_key(index: Column) -> Column:
    return F.format_string("frames.zarr/frames/c/%d/0/0", index)


def dims(n: Column, height: Column, width: Column) -> Column:
    return F.format_string("%d,%d,%d", n, height, width)


def as_text(df: DataFrame) -> DataFrame:
    """Numbers and booleans as strings, as chunk metadata carries them."""
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind in ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint")})


def stream_name(name: Column, now: Column) -> Column:
    """A blank name becomes one with the time of day; others stay untrimmed."""
    return F.when(F.trim(F.coalesce(name, F.lit(""))) == "", F.concat(F.lit("RHEED Stream @ "), F.date_format(now, "h:mma"))).otherwise(name)


def frame_shape(dims_: Column) -> Column:
    """(n, height, width) of ``h,w`` or ``n,h,w``; null for other ranks."""
    parts = F.transform(F.split(dims_, ","), lambda x: x.cast("int"))
    return F.when(F.size(parts) == 3, parts).when(F.size(parts) == 2, F.concat(F.array(F.lit(1)), parts))


def part_count(size: Column, part: int = PART_BYTES) -> Column:
    return F.ceil(size / part).cast("bigint")


def parts(files: DataFrame, part: int = PART_BYTES) -> DataFrame:
    """One row a part: its number from 1, offset and length (the last one shorter); an empty file has none."""
    n = part_count(F.col("length"), part)
    rows = files.filter(F.col("length") > 0).withColumn("part", F.explode(F.sequence(F.lit(1).cast("bigint"), n)))
    offset = (F.col("part") - 1) * part
    return rows.withColumns({"offset": offset, "size": F.least(F.lit(part).cast("bigint"), F.col("length") - offset)})


def clean_path(path: Column) -> Column:
    """Without control characters, smart quotes made plain, outer quotes and blanks off."""
    plain = F.translate(F.regexp_replace(path, r"\p{C}", ""), "“”‘’", "\"\"''")
    return F.trim(F.regexp_replace(F.trim(plain), r"^[\"']+|[\"']+$", ""))


def first_present(*columns: Column) -> Column:
    """By value rather than by presence of a key: a key with null gives way to the next."""
    return F.coalesce(*columns)

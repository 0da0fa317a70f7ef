"""Time columns: epoch units, relative offsets, bins. Instants are whole microseconds (bigint) inside the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of time columns, in the order in which they are looked for.
ABSOLUTE = ("UNIX Timestamp", "Unix Timestamp", "unix_timestamp_ms", "unix_timestamp", "timestamp_ms", "timestamp_seconds", "timestamp")
RELATIVE = ("Relative Time", "relative_time_seconds", "Time", "time_seconds")
SAMPLE_TIMES = ("UNIX Timestamp", "Unix Timestamp", "unix_timestamp_ms", "unix_timestamp", "timestamp", "Time", "time_seconds")
#: Columns that say when a row was taken and so are no signal of their own.
TIME_METRICS = ("Time", "UNIX Timestamp", "Relative Time", "timestamp", "timestamp_ms", "timestamp_seconds")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing here; as null it is skipped by every aggregate."""
    floats = {c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c, kind in df.dtypes if kind in ("double", "float")}
    return df.withColumns(floats) if floats else df


def pick(columns: list[str], names: tuple[str, ...]) -> str | None:
    """The first of ``names`` that is present."""
    return next((n for n in names if n in columns), None)


def epoch_micros(value: Column, largest: Column) -> Column:
    """Microseconds of an epoch number whose unit its item's largest value tells (s, ms, us or ns).

    In decimals: a double has no room for the last digits of nanoseconds."""
    scale = F.when(largest > 1e18, F.lit("0.001")).when(largest > 1e15, F.lit("1")).when(largest > 1e12, F.lit("1000")).otherwise(F.lit("1000000"))
    return F.round(value * scale.cast("decimal(11,3)")).cast("bigint")


def absolute_times(df: DataFrame, item: list[str], column: str) -> DataFrame:
    """``df`` with ``time_us`` from an epoch or text column; rows without a valid time go.

    Any number in an item's column makes the values that are no numbers null; a column of text alone is read as dates.
    """
    # Numbers in exponents and beyond the decimal's range are read as doubles first.
    number = F.expr(f"coalesce(try_cast(`{column}` AS decimal(26,6)), try_cast(try_cast(`{column}` AS double) AS decimal(26,6)))")
    each = Window.partitionBy(*item)
    text = F.unix_micros(F.expr(f"try_cast(cast(`{column}` AS string) AS timestamp)"))
    timed = df.withColumns({"_number": number, "_largest": F.max(number).over(each)})
    time = F.when(F.col("_largest").isNotNull(), epoch_micros(F.col("_number"), F.col("_largest"))).otherwise(text)
    return timed.withColumn("time_us", time).drop("_number", "_largest").filter("time_us IS NOT NULL")


def relative_seconds(columns: list[str]) -> Column | None:
    name = pick(columns, RELATIVE)
    return F.expr(f"try_cast(`{name}` AS double)") if name else None


def since_upload(base: Column, seconds: Column) -> Column:
    """Absolute microseconds of an offset from the time of upload."""
    return F.unix_micros(base) + F.round(seconds * 1e6).cast("bigint")


def item_times(df: DataFrame, item: list[str], upload: str) -> DataFrame:
    """``df`` with ``time_us``: of the first absolute column that is present; without one, of ``upload`` and a relative
    column; no rows where there is neither."""
    name = pick(df.columns, ABSOLUTE)
    if name is not None:
        return absolute_times(df, item, name)
    offset = relative_seconds(df.columns)
    if offset is None or upload not in df.columns:
        return df.withColumn("time_us", F.lit(None).cast("bigint")).filter("false")
    return df.withColumn("time_us", since_upload(F.col(upload), offset)).filter("time_us IS NOT NULL")


def sample_time(columns: list[str]) -> tuple[Column, bool, str] | None:
    """Time in microseconds by the sample's rule, whether it is absolute (a name with ``timestamp``: epoch ms), and the
    column's name."""
    name = pick(columns, SAMPLE_TIMES)
    if name is None:
        return None
    absolute = "timestamp" in name.lower()
    return F.round(F.expr(f"try_cast(`{name}` AS double)") * (1e3 if absolute else 1e6)).cast("bigint"), absolute, name


def midnight(time_us: Column) -> Column:
    return time_us - F.pmod(time_us, F.lit(86_400_000_000))


def bin_start(time_us: Column, origin: Column, step: Column) -> Column:
    """Start of the bin on the grid that begins at ``origin``, in whole microseconds."""
    return origin + F.floor((time_us - origin) / step).cast("bigint") * step

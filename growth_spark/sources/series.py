"""Series payloads to tidy tables, by domain; snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import nan_to_null

# Display names of metrics.
STATISTICS = {"_z_score": "Z Score", "_ema_z_score": "EMA Z Score", "_anomaly_probability": "Anomaly Probability"}
RHEED_NAMES = {
    "time_seconds": "Time",
    "relative_time_seconds": "Relative Time",
    "unix_timestamp_ms": "UNIX Timestamp",
    "frame_number": "Frame Number",
    "cluster_id": "Cluster ID",
    "cluster_std": "Cluster ID Uncertainty",
    "referenced_strain": "Strain",
    "nearest_neighbor_strain": "Cumulative Strain",
    "oscillation_period": "Oscillation Period",
    "spot_count": "Diffraction Spot Count",
    "first_order_intensity": "First Order Intensity",
    "first_order_intensity_l": "First Order Intensity L",
    "first_order_intensity_r": "First Order Intensity R",
    "half_order_intensity": "Half Order Intensity",
    "half_order_intensity_l": "Half Order Intensity L",
    "half_order_intensity_r": "Half Order Intensity R",
    "specular_intensity": "Specular Intensity",
    "reconstruction_intensity": "Reconstruction Intensity",
    "specular_fwhm_1": "Specular FWHM",
    "first_order_fwhm_1": "First Order FWHM",
    "lattice_spacing": "Lattice Spacing",
    "tar_metric": "TAR Metric",
}
OPTICAL_NAMES = {
    "relative_time_seconds": "Time",
    "frame_number": "Frame Number",
    "unix_timestamp_ms": "UNIX Timestamp",
    "perimeter_px": "Edge Perimeter",
    "circularity": "Edge Circularity",
    "edge_roughness": "Edge Roughness",
    "hausdorff_px": "Hausdorff Similarity",
}
METROLOGY_NAMES = {
    "relative_time_seconds": "Time",
    "frame_number": "Frame Number",
    "unix_timestamp_ms": "UNIX Timestamp",
    "ratio_pyrometer": "Ratio Pyrometer",
    "sc_pyrometer": "SC Pyrometer",
    "decay_constant_minutes": "Decay Constant",
    "median_period": "Median Period",
    "median_period_seconds": "Median Period",
    "decay_fit": "Decay Fit",
}
DROP_IF_EMPTY = ("reconstruction_intensity", "tar_metric")


def with_statistics(names: dict[str, str]) -> dict[str, str]:
    """A rename map with the three precomputed statistics of every metric."""
    return names | {f"{source}{suffix}": f"{label} {text}" for source, label in names.items() for suffix, text in STATISTICS.items()}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Display names; where two sources share a name, the first that has a value fills it."""
    targets: dict[str, list[str]] = {}
    for c in df.columns:
        targets.setdefault(names.get(c, c), []).append(c)
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in cs]).alias(t) for t, cs in targets.items()])


def drop_if_empty(df: DataFrame, columns: tuple[str, ...] = DROP_IF_EMPTY) -> DataFrame:
    """Without those of ``columns`` that hold no value at all (one pass to find out)."""
    there = [c for c in columns if c in df.columns]
    if not there:
        return df
    counts = df.agg(*[F.count(c).alias(c) for c in there]).first()
    return df.drop(*[c for c in there if not counts[c]])


def rheed(df: DataFrame) -> DataFrame:
    """``series_by_angle`` (blocks of an angle and its series) as rows: data_id, Angle, metrics."""
    blocks = df.select("data_id", F.explode("series_by_angle").alias("b"))
    rows = blocks.select("data_id", F.col("b.angle").alias("Angle"), F.inline("b.series"))
    return renamed(drop_if_empty(nan_to_null(rows)), RHEED_NAMES)


def _flat(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``series`` as an array, or inside a struct of that name, as rows."""
    nested = dict(df.dtypes)["series"].startswith("struct")
    rows = df.select("data_id", F.inline(F.col("series.series") if nested else F.col("series")))
    return renamed(nan_to_null(rows), with_statistics(names))


def optical(df: DataFrame) -> DataFrame:
    return _flat(df, OPTICAL_NAMES)


def metrology(df: DataFrame) -> DataFrame:
    return _flat(df, METROLOGY_NAMES)


def snapshots(df: DataFrame, required: bool = False) -> DataFrame:
    """(data_id, image_uuid, timestamp_seconds, …): frames without an id are skipped, or an error where required."""
    rows = df.select("data_id", F.inline("frames"))
    rows = rows.select("data_id", "image_uuid", *[c for c in ("timestamp_seconds", "time_seconds") if c in rows.columns])
    if required:
        checked = F.when(F.col("image_uuid").isNotNull(), F.col("image_uuid")).otherwise(F.raise_error(F.lit("a snapshot has no image_uuid")).cast("string"))
        return rows.withColumn("image_uuid", checked)
    return rows.filter("image_uuid IS NOT NULL")


#: Domain to reader; users add their own.
READERS: dict[str, Callable[[DataFrame], DataFrame]] = {"rheed": rheed, "optical": optical, "metrology": metrology}


def domain(kind: Column) -> Column:
    """Domain of a catalogue type: the rheed types are one, recipes are metrology, others are their own."""
    return F.when(kind.startswith("rheed"), F.lit("rheed")).when(kind == "recipe", F.lit("metrology")).otherwise(kind)


def reader(name: str) -> Callable[[DataFrame], DataFrame]:
    if name not in READERS:
        raise ValueError(f"no reader for domain {name!r}; known: {sorted(READERS)}")
    return READERS[name]


def long(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row a metric and value: the form that alignment takes."""
    wide = df.select(*[f"`{k}`" for k in keys], *[F.col(f"`{m}`").cast("double").alias(m) for m in metrics])
    return wide.unpivot([f"`{k}`" for k in keys], [f"`{m}`" for m in metrics], "metric", "value")


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that a numeric mean takes: numbers and booleans."""
    return [c for c, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or kind.startswith("decimal")]

"""Spectra: parallel lists of axis and intensities, peaks and composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import first_present


def _list(df: DataFrame, *names: str):
    found = [F.col(n) for n in names if n in df.columns]
    return first_present(*found, F.array().cast("array<double>"))


def xps(df: DataFrame) -> DataFrame:
    return df.select("data_id", F.lit("xps").alias("kind"), F.col("xps_id").cast("string").alias("result_id"), _list(df, "binding_energies").alias("axis"), _list(df, "intensities").alias("intensities"), "detected_peaks", "predicted_composition", "elements_manually_set", "last_updated")


def photoluminescence(df: DataFrame) -> DataFrame:
    ids = [F.col(c).cast("string") for c in ("photoluminescence_id", "id") if c in df.columns]
    return df.select("data_id", F.lit("photoluminescence").alias("kind"), first_present(*ids).alias("result_id"), _list(df, "energies").alias("axis"), _list(df, "intensities").alias("intensities"), "detected_peaks", "last_updated")


def raman(df: DataFrame) -> DataFrame:
    ids = [F.col(c).cast("string") for c in ("raman_id", "id") if c in df.columns]
    return df.select("data_id", F.lit("raman").alias("kind"), first_present(*ids).alias("result_id"), _list(df, "energies", "wavenumbers").alias("axis"), _list(df, "intensities").alias("intensities"), "detected_peaks", "last_updated")


def points(df: DataFrame) -> DataFrame:
    """One row a point: (data_id, pos, x, intensity); lists of unequal length are an error."""
    even = F.when(F.size("axis") == F.size("intensities"), F.arrays_zip(F.col("axis").alias("x"), F.col("intensities").alias("intensity"))).otherwise(F.raise_error(F.lit("axis and intensities differ in length")))
    return df.select("data_id", F.posexplode(even).alias("pos", "p")).select("data_id", "pos", "p.x", "p.intensity")


def as_json(df: DataFrame, name: str = "result") -> DataFrame:
    """Whole rows as JSON text; ``from_json`` with the same schema gives them back."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def from_json(df: DataFrame, schema, name: str = "result") -> DataFrame:
    return df.select(F.from_json(name, schema).alias("r")).select("r.*")

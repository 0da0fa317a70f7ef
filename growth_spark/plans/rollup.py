"""Samples and projects with their entries, as tables that share keys instead of a tree of objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import align
from ..sources.series import domain


def sample_entries(samples: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of each sample, with the sample's name: from its row, else from its first entry (by seq)."""
    names = entries.groupBy("physical_sample_id").agg(F.min_by("physical_sample_name", F.when(F.col("physical_sample_name").isNotNull(), F.col("seq"))).alias("_entry_name"))
    named = samples.select("physical_sample_id", F.col("name").alias("_name")).join(names, "physical_sample_id", "left")
    named = named.select("physical_sample_id", F.coalesce("_name", "_entry_name").alias("sample_name"))
    return entries.drop("physical_sample_name").join(named, "physical_sample_id").withColumn("domain", domain(F.col("char_source_type")))


def project_entries(project_samples: DataFrame, samples: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of all samples of each project: one plan of three joins instead of a loop over samples."""
    return project_samples.join(sample_entries(samples, entries), "physical_sample_id")


def split_results(entries: DataFrame, series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries that have a series, entries that have none)."""
    ids = series.select("data_id").distinct()
    return entries.join(ids, "data_id", "left_semi"), entries.join(ids, "data_id", "left_anti")


def project_series(project_samples: DataFrame, samples: DataFrame, entries: DataFrame, series: DataFrame) -> DataFrame:
    """All series of the given projects' samples aligned together, always on the outer grid."""
    ids = project_entries(project_samples, samples, entries).select("data_id").distinct()
    return align(series.join(ids, "data_id", "left_semi"), "outer")


def counts(project_samples: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data items of each sample, samples of each project)."""
    items = entries.groupBy("physical_sample_id").agg(F.count("*").alias("num_data_items"))
    return items, project_samples.groupBy("project_id").agg(F.count_distinct("physical_sample_id").alias("physical_sample_count"))

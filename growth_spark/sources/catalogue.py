"""Catalogue, physical samples and projects: nested rows to display tables, and the filters of a search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keywords import any_keyword

# Display names, columns that are dropped, display order.
CATALOGUE_NAMES = {
    "data_id": "Data ID",
    "upload_datetime": "Upload Datetime",
    "last_accessed_datetime": "Last Accessed Datetime",
    "char_source_type": "Type",
    "raw_name": "File Name",
    "pipeline_status": "Status",
    "raw_file_type": "File Type",
    "source_name": "Instrument Source",
    "sample_name": "Sample Name",
    "growth_length": "Growth Length",
    "physical_sample_id": "Physical Sample ID",
    "physical_sample_name": "Physical Sample Name",
    "detail_note_content": "Sample Notes",
    "detail_note_last_updated": "Sample Notes Last Updated",
    "file_metadata": "File Metadata",
    "tags": "Tags",
    "name": "Owner",
    "workspaces": "Workspaces",
    "project_ids": "Project ID",
    "project_names": "Project Name",
}
CATALOGUE_DROP = ("user_id", "synth_source_id", "sample_id", "processed_file_type", "bucket_file_name", "projects")
CATALOGUE_ORDER = ("Data ID", "File Name", "Type", "Status", "File Type", "Instrument Source", "Sample Name", "Physical Sample ID", "Physical Sample Name", "Project ID", "Project Name", "Growth Length", "Upload Datetime", "Last Accessed Datetime", "Sample Notes", "Sample Notes Last Updated", "File Metadata", "Tags", "Owner", "Workspaces")
SAMPLE_NAMES = {
    "physical_sample_metadata": "Sample Metadata",
    "name": "Physical Sample Name",
    "last_updated": "Last Updated",
    "created_datetime": "Created Datetime",
    "id": "Physical Sample ID",
    "owner_name": "Owner",
    "target_material": "Target Material",
    "growth_instrument": "Growth Instrument",
    "num_data_items": "Data Items",
    "project_id": "Project ID",
    "project_name": "Project Name",
    "detail_note_content": "Sample Notes",
    "detail_note_last_updated": "Sample Notes Last Updated",
}
SAMPLE_DROP = ("sample_id", "detail_notes_id", "user_id", "growth_instrument_id", "version", "owner_id", "projects", "detail_notes")
SAMPLE_ORDER = ("Physical Sample ID", "Physical Sample Name", "Project ID", "Project Name", "Target Material", "Sample Metadata", "Sample Notes", "Sample Notes Last Updated", "Growth Instrument", "Data Items", "Created Datetime", "Last Updated", "Owner")
PROJECT_NAMES = {
    "id": "Project ID",
    "last_updated": "Last Updated",
    "name": "Project Name",
    "physical_sample_count": "Physical Sample Count",
    "owner_name": "Owner",
    "detail_note_content": "Project Notes",
    "detail_note_last_updated": "Project Notes Last Updated",
}
PROJECT_DROP = ("owner_id", "detail_note")
PROJECT_ORDER = ("Project ID", "Project Name", "Physical Sample Count", "Project Notes", "Project Notes Last Updated", "Last Updated", "Owner")
# Columns of the summary of an entry without a reader.
SUMMARY = ("raw_name", "pipeline_status", "raw_file_type", "upload_datetime", "last_accessed_datetime", "char_source_type", "physical_sample_id", "project_ids")
# Types of data that a reader knows.
KNOWN_TYPES = ("rheed_image", "rheed_stationary", "rheed_rotating", "rheed_xscan", "xps", "photoluminescence", "pl", "raman", "recipe", "metrology", "optical")

CATALOGUE_SCHEMA = (
    "data_id string, raw_name string, char_source_type string, pipeline_status string, raw_file_type string, source_name string, sample_name string, "
    "physical_sample_id string, physical_sample_name string, growth_length bigint, upload_datetime timestamp, last_accessed_datetime timestamp, "
    "detail_note_content string, detail_note_last_updated string, file_metadata string, tags array<string>, name string, workspaces array<string>, "
    "projects array<struct<id string, name string>>, user_id string, synth_source_id string, sample_id string, processed_file_type string, bucket_file_name string"
)


def not_a_time(column: str) -> Column:
    """The text ``NaT`` and NaN stand for no value."""
    return F.nullif(F.nullif(F.col(column).cast("string"), F.lit("NaT")), F.lit("NaN"))


def first_project(field: str, column: str = "projects") -> Column:
    return F.try_element_at(F.col(column), F.lit(1))[field]


def display(df: DataFrame, names: dict[str, str], drop: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Bookkeeping columns dropped, the rest renamed; known ones first in display order, unknown ones behind."""
    df = df.drop(*drop).withColumnsRenamed(names)
    return df.select(*[f"`{c}`" for c in [*(c for c in order if c in df.columns), *(c for c in df.columns if c not in order)]])


def catalogue(df: DataFrame) -> DataFrame:
    if "projects" in df.columns:
        df = df.withColumns({"project_ids": first_project("id"), "project_names": first_project("name")})
    if "detail_note_last_updated" in df.columns:
        df = df.withColumn("detail_note_last_updated", not_a_time("detail_note_last_updated"))
    return display(df, CATALOGUE_NAMES, CATALOGUE_DROP, CATALOGUE_ORDER)


def with_notes(df: DataFrame, column: str) -> DataFrame:
    """Content and time of a nested note as columns, null where the note is."""
    if column not in df.columns:
        return df
    df = df.withColumns({"detail_note_content": F.col(f"{column}.content"), "detail_note_last_updated": F.col(f"{column}.last_updated")})
    return df.withColumn("detail_note_last_updated", not_a_time("detail_note_last_updated"))


def physical_samples(df: DataFrame) -> DataFrame:
    if "projects" in df.columns:
        df = df.withColumns({"project_id": first_project("id"), "project_name": first_project("name")})
    if "target_material" in df.columns:
        material = F.col("target_material")
        df = df.withColumn("target_material", F.when(material.isNotNull(), F.struct(material["substrate"].alias("substrate"), material["sample_name"].alias("sample_name"))))
    return display(with_notes(df, "detail_notes"), SAMPLE_NAMES, SAMPLE_DROP, SAMPLE_ORDER)


def projects(df: DataFrame) -> DataFrame:
    return display(with_notes(df, "detail_note"), PROJECT_NAMES, PROJECT_DROP, PROJECT_ORDER)


def project_samples(df: DataFrame) -> DataFrame:
    """(project_id, physical_sample_id) from projects with their list of samples; samples without an id are skipped."""
    rows = df.select(F.col("project_id"), F.explode("samples").alias("s"))
    return rows.select("project_id", F.col("s.id").alias("physical_sample_id")).filter("physical_sample_id IS NOT NULL")


def summary(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SUMMARY if c in df.columns])


def _listed(value) -> list:
    return [value] if isinstance(value, str) or not hasattr(value, "__iter__") else list(value)


def search(
    df: DataFrame,
    *,
    keywords=None,
    data_ids=None,
    physical_sample_ids=None,
    project_ids=None,
    data_type: str = "all",
    status: str = "all",
    growth_length: tuple = (None, None),
    upload_datetime: tuple = (None, None),
    last_accessed_datetime: tuple = (None, None),
    owner: str | None = None,
    include_organization_data: bool = True,
) -> DataFrame:
    """Catalogue rows that pass all given filters, which Spark pushes into the scan.

    Bounds are inclusive and open where None; a set bound drops rows without a value. Keywords (any of them, whatever
    their case, in any field, nested ones too) apply to what the other filters leave. Without the organisation's data only
    rows of ``owner`` are left, who must be named.
    """
    for column, wanted in (("data_id", data_ids), ("physical_sample_id", physical_sample_ids)):
        if wanted is not None:
            df = df.filter(F.col(column).isin([str(x) for x in _listed(wanted)]))
    if project_ids is not None:
        ids = [str(x) for x in _listed(project_ids)]
        df = df.filter(F.exists("projects", lambda p: p["id"].isin(ids)))
    if data_type != "all":
        df = df.filter(F.col("char_source_type") == data_type)
    if status != "all":
        df = df.filter(F.col("pipeline_status") == status)
    for column, (low, high) in (("growth_length", growth_length), ("upload_datetime", upload_datetime), ("last_accessed_datetime", last_accessed_datetime)):
        if low is not None:
            df = df.filter(F.col(column) >= F.lit(low))
        if high is not None:
            df = df.filter(F.col(column) <= F.lit(high))
    if not include_organization_data:
        if owner is None:
            raise ValueError("without the organisation's data an owner must be given")
        df = df.filter(F.col("name") == owner)
    return df if keywords is None else df.filter(any_keyword(df, _listed(keywords)))


def containing(df: DataFrame, column: str, *words: str) -> DataFrame:
    """Rows whose ``column`` holds any of ``words`` as they are written; rows without a value hold none."""
    found = F.lit(False)
    for word in words:
        found = found | F.coalesce(F.contains(F.col(f"`{column}`"), F.lit(word)), F.lit(False))
    return df.filter(found)


def unknown_types(df: DataFrame) -> DataFrame:
    """Rows of types that no reader knows keep their catalogue entry."""
    return df.filter(~F.col("char_source_type").isin(*KNOWN_TYPES) | F.col("char_source_type").isNull())


def in_order(df: DataFrame, ids: DataFrame, key: str = "data_id") -> DataFrame:
    """Rows of the requested ids in the order of the request (pos, id); repeats count once, unknown ids vanish."""
    wanted = ids.groupBy(F.col(key)).agg(F.min("pos").alias("pos"))
    return df.join(wanted, key).orderBy("pos")

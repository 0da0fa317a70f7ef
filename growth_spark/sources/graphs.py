"""Pattern graphs, masks and images as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nodes(df: DataFrame, schema: str) -> DataFrame:
    """Nodes of node-link JSON (column ``graph``), with their order in the document as ``seq``."""
    parsed = df.select("data_id", F.from_json("graph", f"nodes array<struct<{schema}>>").alias("g"))
    return parsed.select("data_id", F.posexplode("g.nodes").alias("seq", "n")).select("data_id", F.col("seq").cast("bigint").alias("seq"), "n.*")


def edges(df: DataFrame, schema: str = "weight:double,horizontal_weight:double,vertical_weight:double,horizontal_overlap:boolean") -> DataFrame:
    """Edges of node-link JSON, listed under ``horizontal_distances`` by start_id and end_id."""
    parsed = df.select("data_id", F.from_json("graph", f"horizontal_distances array<struct<start_id:bigint,end_id:bigint,{schema}>>").alias("g"))
    return parsed.select("data_id", F.inline("g.horizontal_distances")).withColumnsRenamed({"start_id": "start_node", "end_id": "end_node"})


def pixels(df: DataFrame, width: int, column: str = "image") -> DataFrame:
    """(data_id, y, x, intensity) of images given as one array in row order."""
    rows = df.select("data_id", F.posexplode(column).alias("i", "v"))
    return rows.select("data_id", F.expr(f"i div {width}").cast("int").alias("y"), (F.col("i") % width).alias("x"), F.col("v").cast("double").alias("intensity"))

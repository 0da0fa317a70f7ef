"""Tables in the shared checkpoint folder that cut the lineage of iterative plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the session's checkpoint folder. Only where none is set and Spark runs in one process, a temporary one
    serves; elsewhere executors would not see it, and that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
    return f"{root.rstrip('/')}/growth-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder and read again."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a partition, where a task sorts or hashes all of its rows.
EACH = 1 << 19


def crowded(spark: SparkSession, rows: int, each: int = EACH) -> bool:
    """Whether the session's number of partitions makes more than about ``each`` rows of a partition."""
    return -(-rows // each) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, keys: list[str], rows: int, each: int = EACH) -> DataFrame:
    """``df`` dealt out by ``keys`` to partitions of about ``each`` rows, where the session's number of partitions would make them
    larger; so a task's memory does not grow with the table. ``rows`` is about the number of rows."""
    return df.repartition(-(-rows // each), *keys) if crowded(df.sparkSession, rows, each) else df.repartition(*keys)


def components(pairs: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node in ``pairs`` (a, b): the smallest node that it reaches.

    Each round points every root to its smallest neighbour, that one's neighbour in turn, and contracts the pairs, so
    long chains take few rounds. Nothing is gathered by component.
    """
    edges = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), name)
    labels = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("up"))
        for _ in range(2):
            up = up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up"))
        up = cut(up, name)
        labels = cut(labels.join(up.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), name)
        x, y = (up.select(F.col("node").alias(c), F.col("up").alias(u)) for c, u in (("a", "ua"), ("b", "ub")))
        edges = cut(edges.join(x, "a").join(y, "b").filter("ua != ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), name)
    return labels


def numbered(df: DataFrame, order: list[str | Column], name: str, start: int = 0) -> DataFrame:
    """``df`` with its rows numbered in ``order`` in column ``name``: a global sort, then one offset a partition."""
    rows = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted").withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_least"))
    offset = F.sum("n").over(Window.orderBy("_part")) - F.col("n") + start  # one row a partition
    return rows.join(F.broadcast(sizes.select("_part", "_least", offset.alias("_before"))), "_part").withColumn(name, F.col("_at") - F.col("_least") + F.col("_before")).drop("_at", "_part", "_least", "_before")

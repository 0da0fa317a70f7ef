"""Keyword search over all fields of a table, nested ones too, and an index that tells which blocks of it to read."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType

#: Characters of a gram, and rows of a block.
GRAM, BLOCK_ROWS = 3, 50_000
#: Rows that a task sorts and cuts into blocks: tasks, and samples of the order, are as many as these ask for and not as the blocks.
TASK_ROWS = 1 << 17
#: Folders of a block: Spark lists those of the first level in a task each.
PLACE = ("_part", "_block")


def _texts(value: Column, kind: DataType) -> Column:
    """All that a value holds, as an array of texts: itself, or what its parts hold; nulls and bytes hold none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        parts = [_texts(value[f.name], f.dataType) for f in kind.fields]
        return F.when(value.isNotNull(), F.concat(*parts)).otherwise(none) if parts else none
    if isinstance(kind, MapType):
        keys, values = _texts(F.map_keys(value), ArrayType(kind.keyType)), _texts(F.map_values(value), ArrayType(kind.valueType))
        return F.when(value.isNotNull(), F.concat(keys, values)).otherwise(none)
    if isinstance(kind, ArrayType):
        return F.when(value.isNotNull(), F.flatten(F.transform(value, lambda x: _texts(x, kind.elementType)))).otherwise(none)
    if isinstance(kind, BinaryType):
        return none
    return F.array_compact(F.array(value.cast("string")))


def texts(df: DataFrame) -> Column:
    """The texts of all fields of a row, in lower case; numbers, times and truth values as they are written."""
    return F.concat(*(F.transform(_texts(F.col(f"`{f.name}`"), f.dataType), F.lower) for f in df.schema.fields))


def any_keyword(df: DataFrame, words: list[str]) -> Column:
    """Whether some field of a row, whatever its case, holds one of ``words``; an empty word is in every text."""
    wanted = [F.lower(F.lit(str(w))) for w in words]

    def held(text: Column) -> Column:
        found = F.lit(False)
        for w in wanted:
            found = found | F.contains(text, w)
        return found

    return F.exists(texts(df), held)


def build(df: DataFrame, path: str, order: str, rows: int = BLOCK_ROWS) -> None:
    """``df`` written to ``path`` in blocks of about ``rows`` rows in ``order``, with the grams that each block holds.

    Rows that are alike in ``order`` lie together, so names, samples and times that a keyword picks are in few blocks. A block is
    numbered by the place of its first row. The index has a row for each gram of a block, sorted by gram, so that a search reads
    the row groups of its grams only.
    """
    n = max(1, -(-df.count() // max(rows, TASK_ROWS)))
    at = F.col("_at")
    placed = df.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    # The lower 33 bits are the row's place in its partition.
    blocks = placed.withColumn("_block", at - at.bitwiseAND(F.lit((1 << 33) - 1)) % rows).withColumn("_part", F.shiftright(at, 33)).drop("_at")
    blocks.write.mode("overwrite").partitionBy(*PLACE).parquet(f"{path}/rows")
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/schema")
    held = _rows(spark, path)

    def grams(text: Column) -> Column:
        starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))

    # A block lies in one file, so most repeats go before the shuffle.
    own = F.array_distinct(F.flatten(F.transform(texts(held.drop(*PLACE)), grams)))
    index = held.select("_block", F.explode(own).alias("gram")).distinct()
    index.repartitionByRange("gram").sortWithinPartitions("gram", "_block").write.mode("overwrite").parquet(f"{path}/grams")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """The table and its blocks, by the schema written with it (an empty table has no file to tell it)."""
    (text,) = (r[0] for r in spark.read.text(f"{path}/schema").collect())
    schema = StructType.fromJson(json.loads(text)).add(PLACE[0], "long").add(PLACE[1], "long")
    return spark.read.schema(schema).parquet(f"{path}/rows")


def grams_of(word: str) -> list[str]:
    low = word.lower()
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})


def blocks_of(spark: SparkSession, path: str, words: list[str]) -> list[int] | None:
    """Numbers of the blocks that may hold one of ``words``; None (all) where a word is too short to have a gram."""
    wanted = [grams_of(str(w)) for w in words]
    if not all(wanted):
        return None
    index = spark.read.schema("_block long, gram string").parquet(f"{path}/grams").filter(F.col("gram").isin(sorted({g for own in wanted for g in own})))
    there = index.groupBy("_block").agg(F.collect_set("gram").alias("grams"))  # at most the grams asked for
    all_of = F.lit(False)
    for own in wanted:
        all_of = all_of | F.forall(F.array(*map(F.lit, own)), lambda g: F.array_contains("grams", g))
    return sorted(r["_block"] for r in there.filter(all_of).select("_block").collect())


def search(spark: SparkSession, path: str, words: list[str] | str) -> DataFrame:
    """Rows of the table under ``path`` that hold one of ``words``: only blocks that hold all grams of a word are read, and
    each row in them is verified."""
    words = [words] if isinstance(words, str) else list(words)
    rows = _rows(spark, path)
    blocks = blocks_of(spark, path, words)
    if blocks is not None:
        rows = rows.filter(F.col("_block").isin(blocks) if blocks else F.lit(False))
    rows = rows.drop(*PLACE)
    return rows.filter(any_keyword(rows, words))

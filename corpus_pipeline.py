"""A corpus pipeline: five stages, each on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from growth_spark.llm import decontaminate, language, near_dedup, personal_data, sentencepiece_wfst
from growth_spark.llm.common import Scratch
from growth_spark.llm.queries import table, tokenizer


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that the classifier rejects go."""
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest doc_id."""
    return near_dedup.keep_first(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, personal data in their text replaced by its kind."""
    return personal_data.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of pieces and digests of each text's encoding and of its decoding."""
    return sentencepiece_wfst.round_trip(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("personal_data", without_personal_data),
    ("sentencepiece", encoded),
]

#: SQL can't express compression, the span classifier or the shortest path; the tests hold run() against the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

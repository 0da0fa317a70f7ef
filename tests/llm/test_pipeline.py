"""The pipeline against its stages one by one."""

import corpus_pipeline
from growth_spark.llm import decontaminate, personal_data

SF = "/root/testdata/sf0.001"


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns, name
        assert docs.count() <= kept
        kept = docs.count()
    left = docs.collect()
    assert 0.5 * spark.read.parquet(f"{SF}/documents.parquet").count() < len(left)
    assert all(not personal_data.base_spans(r["text"]) for r in left)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.decontaminate(docs, bench).count() == len(left)
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in left) and all(r["same"] for r in found)


def test_stages_take_awkward_tables(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a column whose name clashes, and no rows at all."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key int"
    long_ = " ".join(f"word{i % 911}" for i in range(30_000))
    rows = [(1, "the same words here for all of you to read", "en", "s", 5, 1), (1, "the same words here for all of you to read", "en", "s", 5, 1), (None, "the same words here for all of you to see", None, None, None, None), (2, None, "en", "s", 0, 1), (3, "", None, "s", 0, 1), (4, long_, "en", "s", len(long_), 1), (5, "ein ganz anderer Satz mit a@b.co darin", "de", "t", 9, 2), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, df, SF)
            assert kept.columns == docs.columns, name
            assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in df.collect()}, name
            assert kept.count() <= df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() == df.count()
    by = dict(corpus_pipeline.STAGES)
    copies = by["near_duplicates"](spark, docs, SF).collect()
    assert sum(r["doc_id"] == 1 for r in copies) in (1, 2) and sum(r["text"] is None for r in copies) == 2  # texts without words stay
    assert by["decontamination"](spark, docs, SF).count() == len(rows)
    redacted = [r["text"] for r in by["personal_data"](spark, docs, SF).collect()]
    assert "ein ganz anderer Satz mit [EMAIL] darin" in redacted and redacted.count(None) == 2 and long_ in redacted

import math
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from growth_spark import queries
from growth_spark.functions import chunks
from growth_spark.operators import ml, stats
from growth_spark.sources import catalogue, files, graphs, series, spectra
from growth_spark.streaming import frames
from growth_spark.sources import keywords
from growth_spark.streaming.poll import Poll


def entry(spark, **values):
    names = [c.split()[0] for c in catalogue.CATALOGUE_SCHEMA.replace("struct<id string, name string>", "x").split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], catalogue.CATALOGUE_SCHEMA)


def test_display_of_entries(spark):
    df = entry(spark, data_id="1", projects=[("p", "P"), ("q", "Q")], detail_note_last_updated="NaT", user_id="u").withColumn("extra", F.lit(7))
    row = catalogue.catalogue(df).first().asDict()
    assert list(row)[:2] == ["Data ID", "File Name"] and list(row)[-1] == "extra"
    assert (row["Project ID"], row["Project Name"], row["Sample Notes Last Updated"]) == ("p", "P", None)
    assert "user_id" not in row and catalogue.catalogue(entry(spark, data_id="1", projects=[])).first()["Project ID"] is None


def test_search_bounds_and_keywords(spark):
    df = entry(spark, data_id="1", growth_length=None, raw_name="Ga_As").unionByName(entry(spark, data_id="2", growth_length=10, raw_name="other"))
    assert catalogue.search(df).count() == 2
    assert [r["data_id"] for r in catalogue.search(df, growth_length=(10, None)).collect()] == ["2"]
    assert [r["data_id"] for r in catalogue.search(df, keywords="ga_").collect()] == ["1"]


def test_keywords_in_any_field(spark):
    df = entry(spark, data_id="1", projects=[("p", "Growth of GaN")], tags=["Blue", None]).unionByName(entry(spark, data_id="2", growth_length=4711, projects=None)).unionByName(entry(spark, data_id="3", projects=[("q", None)], workspaces=[]))
    found = lambda *words: sorted(r["data_id"] for r in catalogue.search(df, keywords=list(words)).collect())
    assert found("gan") == ["1"] and found("BLUE") == ["1"] and found("471") == ["2"] and found("Q") == ["3"]
    assert found("gan", "471") == ["1", "2"] and found("nowhere") == [] and found("") == ["1", "2", "3"] and found() == []
    nested = spark.createDataFrame([(1, {"k": [("x", "Deep")]}, b"deep"), (2, None, None)], "i int, m map<string,array<struct<a:string,b:string>>>, raw binary")
    assert [r["i"] for r in nested.filter(keywords.any_keyword(nested, ["DEE"])).collect()] == [1]
    with pytest.raises(ValueError):
        catalogue.search(df, include_organization_data=False)


def test_the_index_reads_only_blocks_that_may_hold_a_keyword(spark, tmp_path):
    rows = [(i, f"sample {i:05d}", [f"Tag{i % 7}", "common"], None if i % 3 else f"note {i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, name string, tags array<string>, note string")
    path = str(tmp_path / "index")
    keywords.build(df, path, "name", 100)
    for words in (["00042"], ["TAG3"], ["note 33", "e 01999"], ["9"], ["zzz"], ["common"], ["sample 00042", "sample 01234"]):
        want = sorted(r["i"] for r in df.filter(keywords.any_keyword(df, words)).collect())
        assert sorted(r["i"] for r in keywords.search(spark, path, words).collect()) == want, words
    blocks = keywords.blocks_of(spark, path, ["sample 00042"])
    assert 1 <= len(blocks) <= 3 and keywords.blocks_of(spark, path, ["zzz"]) == [] and keywords.blocks_of(spark, path, ["00042", "ab"]) is None
    read = keywords.search(spark, path, "sample 00042").inputFiles()
    assert 1 <= len({f.split("_block=")[1].split("/")[0] for f in read}) <= 20
    plan = keywords.search(spark, path, "sample 00042")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_block" in plan or "PartitionFilters: [isnotnull(_block" in plan
    keywords.build(df.limit(0), path, "name")
    assert keywords.search(spark, path, "sample").count() == 0


def test_rheed_payload(spark):
    schema = "data_id string, series_by_angle array<struct<angle double, series array<struct<time_seconds double, tar_metric double, spot_count bigint>>>>"
    df = spark.createDataFrame([("a", [(0.0, [(1.0, None, 3)]), (90.0, [(float("nan"), None, 4)])])], schema)
    found = series.rheed(df)
    assert found.columns == ["data_id", "Angle", "Time", "Diffraction Spot Count"]
    assert sorted((r["Angle"], r["Time"]) for r in found.collect()) == [(0.0, 1.0), (90.0, None)]
    kept = series.rheed(spark.createDataFrame([("a", [(0.0, [(1.0, 2.0, 3)])])], schema))
    assert "TAR Metric" in kept.columns
    assert series.with_statistics({"a": "A"})["a_ema_z_score"] == "A EMA Z Score"
    with pytest.raises(ValueError):
        series.reader("sem")


def test_snapshots_that_need_an_id(spark):
    df = spark.createDataFrame([("a", [("u", 1.0), (None, 2.0)])], "data_id string, frames array<struct<image_uuid string, timestamp_seconds double>>")
    assert series.snapshots(df).count() == 1
    with pytest.raises(Exception, match="image_uuid"):
        series.snapshots(df, required=True).collect()


def test_graph_json(spark):
    df = spark.createDataFrame([("a", '{"nodes":[{"node_id":3,"area":1.5}],"horizontal_distances":[{"start_id":1,"end_id":3,"weight":2.0}]}')], "data_id string, graph string")
    assert tuple(graphs.nodes(df, "node_id:bigint,area:double").first()) == ("a", 0, 3, 1.5)
    assert graphs.edges(df).first()["end_node"] == 3


def test_spectra_of_unequal_length(spark):
    df = spark.createDataFrame([("a", [1.0], [1.0, 2.0])], "data_id string, axis array<double>, intensities array<double>")
    with pytest.raises(Exception, match="differ in length"):
        spectra.points(df).collect()


def test_file_parts(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"0" * 2500)
    (tmp_path / "y.bin").write_bytes(b"")
    found = files.intake(spark, f"file://{tmp_path}", 1000).collect()
    assert sorted((r["part"], r["offset"], r["size"]) for r in found) == [(1, 0, 1000), (2, 1000, 1000), (3, 2000, 500)]


def test_chunk_rules(spark):
    df = spark.createDataFrame([("  ", 120.0, 0.0, 240), ("x ", 120.0, 10.0, 239)], "name string, fps double, rpm double, chunk_size int")
    rows = df.select(chunks.stream_name(F.col("name"), F.lit("2024-01-01 09:05:00").cast("timestamp")).alias("name"), chunks.frames_per_rotation(F.col("fps"), F.col("rpm")).alias("period"), chunks.chunk_size_ok(F.col("chunk_size"), F.col("fps")).alias("ok"), chunks.chunk_end_ms(F.lit(100), F.lit(7), F.col("fps")).alias("end")).collect()
    assert [tuple(r) for r in rows] == [("RHEED Stream @ 9:05AM", None, True, 158), ("x ", 720.0, False, 158)]
    shapes = spark.createDataFrame([("3,4",), ("2,3,4",), ("5",)], "d string").select(chunks.frame_shape(F.col("d")).alias("s")).collect()
    assert [r["s"] for r in shapes] == [[1, 3, 4], [2, 3, 4], None]


def test_samples_are_linked_or_made(spark):
    streams = spark.createDataFrame([("s1", " GaAs "), ("s2", "new"), ("s3", "NEW"), ("s4", " ")], "data_id string, sample_name string")
    linked, samples = frames.link_samples(streams, spark.createDataFrame([("1", "gaas")], "id string, name string"))
    by = {r["data_id"]: r["physical_sample_id"] for r in linked.collect()}
    assert by["s1"] == "1" and by["s2"] == by["s3"] and by["s4"] is None and samples.count() == 2


def test_streams_close_twice(spark):
    df = spark.createDataFrame([("a", "stream_active"), ("b", "success")], "data_id string, status string")
    once = frames.finalized(df, ["a", "b"])
    assert {tuple(r) for r in once.collect()} == {("a", "stream_finalizing"), ("b", "success")}
    assert {tuple(r) for r in frames.finalized(once, ["a"]).collect()} == {tuple(r) for r in once.collect()}


def follow(spark, batches, **rules):
    out, errors = [], []
    poll = Poll(lambda df, n: out.append(df.first()["v"]), on_error=errors.append, **rules)
    for i, v in enumerate(batches):
        poll.batch(spark.createDataFrame([(v,)], "v string"), i)
    return out, errors, poll


def test_poll_rules(spark):
    key = lambda df: df.first()["v"]
    assert follow(spark, ["1", "2", "3", "4"], max_polls=3)[0] == ["1", "2", "3"]
    assert follow(spark, ["1", "1", "2", "1"], distinct_by=key)[0] == ["1", "2", "1"]
    assert follow(spark, ["ok", "done", "ok"], until=lambda df: key(df) == "done")[0] == ["ok", "done"]


def test_poll_goes_on_after_errors(spark):
    def fails(df):
        if df.first()["v"] == "bad":
            raise RuntimeError("bad")
        return df.first()["v"]

    out, errors, poll = follow(spark, ["bad", "ok"], distinct_by=fails, max_polls=2)
    assert out == ["ok"] and len(errors) == 1 and poll.done


def test_poll_key_survives_a_restart(spark):
    state = "file://" + tempfile.mkdtemp(prefix="spark-") + "/key"
    key = lambda df: df.first()["v"]
    assert follow(spark, ["1", "2"], distinct_by=key, state=state)[0] == ["1", "2"]
    assert follow(spark, ["2", "3"], distinct_by=key, state=state)[0] == ["3"]


def test_stream_stops_by_rule(spark):
    root = tempfile.mkdtemp(prefix="spark-")
    spark.createDataFrame([("x",)], "v string").write.parquet(f"file://{root}/in")
    seen = []
    poll = Poll(lambda df, n: seen.append(df.count()), max_polls=1)
    query = poll.start(spark.readStream.schema("v string").parquet(f"file://{root}/in"), f"file://{root}/checkpoint", interval=0.2)
    for _ in range(300):
        if not query.isActive:
            break
        time.sleep(0.1)
    assert not query.isActive and seen == [1] and os.path.isdir(f"{root}/checkpoint")


def test_bagged_models(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), int(i > 20), i / 40) for i in range(40)], "a double, b double, y int, t double")
    rows = ml.vectors(df, ["a", "b"])
    weights, intercept = ml.bagged_logistic(rows, "y", bags=2)
    scored = ml.applied(df, ["a", "b"], weights, intercept, logistic=True).collect()
    assert sum((r["prediction"] > 0.5) == (r["y"] == 1) for r in scored) >= 36
    weights, intercept = ml.bagged_linear(rows, "t", bags=2)
    assert all(0 <= r["prediction"] <= 1 for r in ml.applied(df, ["a", "b"], weights, intercept).collect())


def test_each_row_is_scored_without_its_fold(spark):
    # Row 0 stands apart with the wrong label: fitted on it, models follow it; without it, they do not.
    data = [(0, 1000.0, 0), *((i, float(i % 2), i % 2) for i in range(1, 9))]
    df = spark.createDataFrame(data, "k bigint, a double, y int")
    found = {r["k"]: r for r in ml.held_out_logistic(df, ["a"], "y", "k", 9, bags=2).collect()}
    assert sorted(r["fold"] for r in found.values()) == list(range(9)) and found[0]["prediction"] > 0.99
    alone, intercept = ml.bagged_logistic(ml.vectors(ml.folds(df, "k", 9), ["a"]).filter(F.col("fold") != found[3]["fold"]), "y", bags=2)
    assert abs(found[3]["prediction"] - 1 / (1 + math.exp(-(alone[0] + intercept)))) < 1e-6
    assert {r["fold"] for r in ml.folds(df, "k", 3).collect()} <= {0, 1, 2} and ml.held_out_logistic(df, ["a"], "y", "k", 3, bags=1).count() == 9


def test_samples_of_one_class_are_drawn_again(spark):
    df = spark.createDataFrame([(float(i), int(i == 0)) for i in range(6)], "a double, y int").coalesce(1)
    rows = ml.vectors(df, ["a"])
    first = next(s for s in range(100) if rows.sample(True, 1.0, s).select("y").distinct().count() == 1)
    weights, _ = ml.bagged_logistic(rows, "y", bags=1, seed=first)
    assert weights[0] < 0
    with pytest.raises(ValueError, match="one class"):
        ml.bagged_logistic(rows.filter("y = 0"), "y", bags=1)


def test_labels_from_names_and_notes(spark):
    rows = [("20240131-V-0.5deg", "0.2deg Quality: Textured"), ("20240201-N2-0.5deg", ""), ("x-V--N2-", None)]
    found = stats.labels(spark.createDataFrame(rows, "`Physical Sample Name` string, `Sample Notes` string"))
    got = [(r["quality"], str(r["run_date"]), r["doping"], r["miscut"]) for r in found.collect()]
    assert got == [("textured", "2024-01-31", "V", "0.2"), ("good", "2024-02-01", "N2", "0.5"), ("good", "None", "V", "none")]


def test_poll_gives_the_last_rows_of_each_item(spark):
    kept, out = "file://" + tempfile.mkdtemp(prefix="spark-") + "/kept", []
    make = lambda: Poll(lambda df, n: out.append(sorted(tuple(r) for r in df.collect())), last_n=2, item=("v",), kept=kept)
    batch = lambda *rows: spark.createDataFrame(rows, "v string, time_us bigint")
    poll = make()
    poll.batch(batch(("a", 1), ("a", 2), ("a", 3), ("b", 1)), 0)
    poll.batch(batch(("b", 2)), 1)
    make().batch(batch(("b", 2)), 1)  # run again after a restart
    make().batch(batch(("a", 9), ("b", 0)), 2)
    one = [("a", 2), ("a", 3), ("b", 1), ("b", 2)]
    assert out == [one[:3], one, one, [("a", 3), ("a", 9), ("b", 1), ("b", 2)]]
    with pytest.raises(ValueError):
        Poll(print, last_n=2)


def test_notes_of_samples_are_the_sql_texts(spark, tmp_path):
    import duckdb

    values = [0.0, -0.0, -0.001, 0.004, 2.675, 1.005, -1.005, 0.29, 0.285, -999.99, 9999.5, 12345678.5, -1234567890.25, 9e14, 1e16, -1.5e300, float("inf"), float("-inf"), float("nan"), None, 0.125, 4516.955]
    spark.createDataFrame([(i, f"c{i}", 0, v, "m") for i, v in enumerate(values)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "n", 0)], "n_nationkey int, n_name string, n_regionkey int").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    con = duckdb.connect()
    for name in ("customer", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(f'SELECT "Physical Sample ID", "Sample Notes" FROM ({queries.ORACLE_SQL["samples_display"]})').fetchall())
    found = queries.QUERIES["samples_display"](spark, str(tmp_path)).select("Physical Sample ID", "Sample Notes").collect()
    assert sorted(map(tuple, found)) == want


def test_blocks_of_the_index_are_no_tasks(spark, tmp_path, monkeypatch):
    """Each task tells the driver of itself and samples the order: their number does not follow that of the blocks."""
    monkeypatch.setattr(keywords, "TASK_ROWS", 50, raising=False)
    df = spark.range(3000).select(F.concat(F.lit("sample "), F.lpad(F.col("id").cast("string"), 5, "0")).alias("name"))
    tracker, group = spark.sparkContext.statusTracker(), f"keywords {tmp_path}"
    spark.sparkContext.setJobGroup(group, "build")
    keywords.build(df, str(tmp_path / "index"), "name", 10)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(k) for j in jobs for k in j.stageIds]
    assert max(k.numTasks for k in stages if k) < 100
    assert len(list((tmp_path / "index" / "rows").glob("*/_block=*"))) == 300
    assert [r["name"] for r in keywords.search(spark, str(tmp_path / "index"), "02999").collect()] == ["sample 02999"]

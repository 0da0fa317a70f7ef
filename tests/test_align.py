import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from growth_spark import queries
from growth_spark.functions import exact
from growth_spark.functions import time as times
from growth_spark.operators import align
from growth_spark.plans.tables import dealt

COLUMNS = "data_id string, domain string, item_pos int, seq bigint, time_us bigint, metric string, value double"


def rows(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def item(name, pos, points, metric="m"):
    return [(name, "d", pos, i, int(t * 1e6), metric, v) for i, (t, v) in enumerate(points)]


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_keep_first_at_equal_times(spark):
    df = rows(spark, [("a", "d", 0, 1, 5, "m", 2.0), ("a", "d", 0, 0, 5, "m", 1.0), ("a", "d", 0, 2, 6, "m", 3.0)])
    assert got(align.first_at_each_time(df), "time_us", "value") == [(5, 1.0), (6, 3.0)]


def test_step_is_the_median_of_medians_with_a_floor(spark):
    df = rows(spark, item("a", 0, [(0, 1.0), (1, 1.0), (3, 1.0)]) + item("b", 1, [(0, 1.0), (2, 1.0)]))
    assert align.step(df).first()[0] == 1_750_000
    assert align.step(rows(spark, item("a", 0, [(0, 1.0), (0.1, 1.0)]))).first()[0] == 500_000


def test_step_without_two_points_keeps_own_times(spark):
    df = rows(spark, item("a", 0, [(3, 1.0)]))
    assert align.step(df).first()[0] is None
    assert got(align.align(df), "data_id", "bin_us", "value") == [("a", 3_000_000, 1.0)]


def test_agreeing_metrics_are_shared_and_one_clash_blocks(spark):
    same = item("a", 0, [(0, 1.0), (1, 2.0)]) + item("b", 1, [(1, 2.0), (2, 3.0)])
    assert got(align.align(rows(spark, same)), "data_id", "bin_us", "value") == [("shared", 0, 1.0), ("shared", 1_000_000, 2.0), ("shared", 2_000_000, 3.0)]
    clash = item("a", 0, [(0, 1.0), (1, 2.0)]) + item("b", 1, [(1, 9.0), (2, 3.0)])
    assert {r["data_id"] for r in align.align(rows(spark, clash)).collect()} == {"a", "b"}


@pytest.mark.parametrize(("how", "expected"), [("outer", [0, 1, 2]), ("inner", [1]), ("left", [0, 1]), ("right", [1, 2]), ("other", [0, 1, 2])])
def test_kinds_of_join(spark, how, expected):
    df = rows(spark, item("a", 0, [(0, 1.0), (1, 2.0)]) + item("b", 1, [(1, 9.0), (2, 3.0)]))
    assert sorted({r["time_us"] // 1_000_000 for r in align.restrict(df, how).collect()}) == expected


def test_interpolation_fills_the_first_bins_of_a_gap(spark):
    values = [None, 0.0, None, None, None, 4.0, None, None]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "signal string, bin_us bigint, value double")
    filled = [r["value"] for r in align.interpolate(df, ["signal"], 2).orderBy("bin_us").collect()]
    assert filled == [None, 0.0, 1.0, 2.0, None, 4.0, 4.0, 4.0]
    with pytest.raises(ValueError):
        align.interpolate(df, ["signal"], 0)


def test_epoch_units(spark):
    base = 1_700_000_000
    data = [(k, float(base * scale)) for k, scale in (("s", 1), ("ms", 10**3), ("us", 10**6), ("ns", 10**9))]
    df = times.absolute_times(spark.createDataFrame(data, "data_id string, timestamp double"), ["data_id"], "timestamp")
    assert {r["time_us"] for r in df.collect()} == {base * 1_000_000}


def test_text_times_and_mixed_columns(spark):
    df = spark.createDataFrame([("a", "2024-01-01T00:00:01"), ("a", "no"), ("b", "5"), ("b", "2024-01-01")], "data_id string, timestamp string")
    found = times.absolute_times(df, ["data_id"], "timestamp").select("data_id", "time_us").collect()
    assert sorted(map(tuple, found)) == [("a", 1_704_067_201_000_000), ("b", 5_000_000)]


def test_bins_start_at_midnight(spark):
    df = spark.createDataFrame([(90_000_000_001,)], "t bigint")
    start = times.bin_start(F.col("t"), times.midnight(F.col("t")), F.lit(7_000_000))
    assert df.select(start.alias("b")).first()[0] == 86_400_000_000 + (3_600_000_001 // 7_000_000) * 7_000_000


def test_alignment_does_not_depend_on_item_order(spark):
    data = item("a", 0, [(0, 1.0), (1, 2.0), (2, 5.0)]) + item("b", 1, [(1, 9.0), (2, 3.0)])
    one = got(align.align(rows(spark, data)), "data_id", "bin_us", "value")
    assert got(align.align(rows(spark, data[::-1])), "data_id", "bin_us", "value") == one


def test_dense_grid_has_empty_bins(spark):
    df = rows(spark, item("a", 0, [(0, 1.0), (1, 2.0), (5, 3.0)], "m"))
    assert [r["value"] for r in align.align(df, dense=True).orderBy("bin_us").collect()][:1] == [1.5]
    steps = spark.range(1).select(F.lit(1_000_000).alias("step_us"))
    assert align.resample(df, steps, ("metric",), dense=True).count() == 6


def brute_labelled(events, step=10_800, limit=4):
    """Per signal and bin, in seconds: means, gaps filled linearly for their first bins, tails held as long."""
    times_ = [t for _, t, *_ in events]
    origin = min(times_) // 86_400 * 86_400
    first, last = (origin + (t - origin) // step * step for t in (min(times_), max(times_)))
    grid, out = range(first, last + 1, step), {}
    for signal in {f"user {u} | {kind}" for _, _, u, kind, _ in events}:
        own = [(origin + (t - origin) // step * step, v) for _, t, u, kind, v in events if f"user {u} | {kind}" == signal]
        mean = {b: sum(v for c, v in own if c == b) / sum(c == b for c, _ in own) for b, _ in own}
        for b in grid:
            before, after = max((c for c in mean if c <= b), default=None), min((c for c in mean if c >= b), default=None)
            if b in mean:
                value = mean[b]
            elif before is None or (b - before) // step > limit:
                value = None
            else:
                value = mean[before] if after is None else mean[before] + (mean[after] - mean[before]) * (b - before) / (after - before)
            out[signal, b * 1_000_000] = value
    return out


def test_labelled_alignment_takes_all_users(spark, tmp_path):
    start = 1_704_070_800  # 01:00 on the first of January 2024
    events = [(i, start + (i * 7919) % 260_000, (0, 3, 19, 20, 21, 150, 4000)[i % 7], "ab"[i % 3 == 0], float(i * i % 31)) for i in range(70)]
    events += [(900, start - 3600, 77, "a", 1.0), (901, start + 400_000, 4000, "b", 2.0)]  # the ends are those of late users
    rows = [(i, datetime.fromtimestamp(t, UTC).replace(tzinfo=None), u, kind, v) for i, t, u, kind, v in events]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").write.parquet(f"file://{tmp_path}/events.parquet")
    want = brute_labelled(events)
    found = {(r["signal"], r["bin_us"]): r["value"] for r in queries.QUERIES["align_labelled_all"](spark, f"file://{tmp_path}").collect()}
    assert found.keys() == want.keys() and {s.split()[1] for s, _ in found} > {"20", "4000"}
    assert all((found[k] is None) == (v is None) and (v is None or abs(found[k] - v) < 1e-5) for k, v in want.items())
    assert {(r["signal"], r["bin_us"]): r["value"] for r in queries.QUERIES["align_labelled"](spark, f"file://{tmp_path}").collect()} == found


def test_item_rows_take_the_first_absolute_column_or_else_the_upload(spark):
    base = datetime(2024, 1, 1, tzinfo=UTC)
    keys = "data_id string, domain string, item_pos int, seq bigint, upload_datetime timestamp, "
    both = spark.createDataFrame([("a", "d", 0, 1, base, 1_700_000_000_000, 5.0, 2.0, "x"), ("a", "d", 0, 2, base, None, 6.0, 3.0, "y")], keys + "`unix_timestamp_ms` bigint, `Relative Time` double, v double, note string")
    rows = align.item_rows(both).filter("metric = 'v'").collect()
    assert [(r["seq"], r["time_us"], r["value"]) for r in rows] == [(1, 1_700_000_000_000_000, 2.0)]
    relative = both.drop("unix_timestamp_ms")
    rows = align.item_rows(relative).filter("metric = 'v'").orderBy("seq").collect()
    assert [r["time_us"] for r in rows] == [int(base.timestamp() * 1e6) + n * 1_000_000 for n in (5, 6)]
    assert align.item_rows(relative.drop("upload_datetime")).count() == 0
    # An absolute column that is there but empty drops the item: the relative one is not tried.
    assert align.item_rows(both.withColumn("unix_timestamp_ms", F.lit(None).cast("bigint"))).count() == 0


def test_nanoseconds_keep_their_microseconds(spark):
    df = spark.createDataFrame([("a", "1700000000123456789"), ("a", "1700000000123457000"), ("b", "1.7e9")], "data_id string, timestamp string")
    found = times.absolute_times(df, ["data_id"], "timestamp").orderBy("data_id", "time_us").collect()
    assert [r["time_us"] for r in found] == [1_700_000_000_123_457, 1_700_000_000_123_457, 1_700_000_000_000_000]


def test_labelled_frames_and_their_errors(spark):
    one = spark.createDataFrame([(1000.0, 1.0, 7), (2000.0, 2.0, 8)], "`UNIX Timestamp` double, v double, `Frame Number` int")
    rows, absolute = align.labelled_rows({"x": one, "none": spark.createDataFrame([(1,)], "v int")})
    assert absolute and sorted((r["label"], r["time_us"], r["metric"], r["value"]) for r in rows.collect()) == [("x", 1_000_000, "v", 1.0), ("x", 2_000_000, "v", 2.0)]
    other = one.withColumnRenamed("UNIX Timestamp", "Time")
    with pytest.raises(ValueError):
        align.labelled_rows({"x": one, "y": other})
    with pytest.raises(TypeError):
        align.labelled_rows({"x": one.withColumn("note", F.lit("text"))})
    with pytest.raises(Exception, match="more than one row"):
        align.labelled_rows({"x": one.unionByName(one)})[0].collect()
    assert align.labelled_rows({"none": spark.createDataFrame([(1,)], "v int")}) is None


def test_medians_and_interpolation_of_a_long_signal(spark):
    rows = spark.range(200_000).select(F.lit("a").alias("data_id"), F.lit("d").alias("domain"), F.lit(0).alias("item_pos"), F.col("id").alias("seq"), (F.col("id") * 1_000_000 + F.when(F.col("id") % 3 == 0, 200_000).otherwise(0)).alias("time_us"))
    gap = sorted(b - a for a, b in zip(*(lambda t: (t, t[1:]))([i * 1_000_000 + (200_000 if i % 3 == 0 else 0) for i in range(200_000)])))
    assert align.step(rows).first()["step_us"] == (gap[len(gap) // 2] if len(gap) % 2 else (gap[len(gap) // 2 - 1] + gap[len(gap) // 2]) // 2)
    dense = rows.select(F.lit("s").alias("signal"), F.col("seq").alias("bin_us"), F.when(F.col("seq") % 100 == 0, F.col("seq").cast("double")).alias("value"))
    filled = align.interpolate(dense, ["signal"], 99)
    assert filled.filter("bin_us < 199900 AND abs(value - bin_us) < 0.000001").count() == 199_900  # linear in time: seconds, not hours


def test_a_large_dense_grid_is_not_broadcast(spark):
    """Null bins take no room in a file, so the size of the means' file says nothing of their number."""
    df = rows(spark, [r for k in range(40) for r in item(f"i{k}", k, [(0, 1.0), (1, 2.0), (2000, 3.0 + k)])])
    made = align.align(df, dense=True)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "leftHint" not in plan
    values = {(r["data_id"], r["bin_us"]): r["value"] for r in made.collect()}
    bins = sorted({b for _, b in values})
    assert len(bins) == len(values) / 40 and values["i3", bins[-1]] == 6.0 and sum(v is not None for v in values.values()) == 40 * 2


@pytest.mark.parametrize("limit", [1, 4, 2000])
def test_grids_unfolded_from_means_are_interpolated_dense_ones(spark, limit):
    rng = random.Random(3)
    means = [(name, t * 10, None if rng.random() < empty else rng.random()) for name, empty in (("a", 0.2), ("none", 1.0), (None, 0.5), ("late", 0.1)) for t in sorted(rng.sample(range(600 if name == "late" else 0, 900), 90))]
    df = spark.createDataFrame(means, "signal string, bin_us bigint, value double").repartition(4)
    one = spark.createDataFrame([(0, 0, 8990, 10)], "origin_us bigint, first_us bigint, last_us bigint, step_us bigint")
    known = {(s, b): v for s, b, v in means}
    dense = spark.createDataFrame([(s, b, known.get((s, b))) for s in {m[0] for m in means} for b in range(0, 9000, 10)], df.schema)
    want = sorted(map(tuple, align.interpolate(dense, ["signal"], limit).collect()), key=repr)
    for most in (1 << 20, 16):
        assert sorted(map(tuple, align.on_grid(df, df, one, ["signal"], limit, most).collect()), key=repr) == want


def test_partitions_of_alignment_follow_the_rows(spark):
    """More rows than the session's partitions should hold are dealt out to more; a constant domain, as queries have it, does not undo that."""
    made = spark.range(4000).select((F.col("id") % 40).cast("string").alias("data_id"), F.lit("d").alias("domain"), (F.col("id") % 40).alias("item_pos"), F.col("id").alias("seq"), ((F.col("id") - F.col("id") % 3) * 1_000_000).alias("time_us"), F.lit("m").alias("metric"), (F.col("id") % 7 / 10).alias("value"))
    first = align.first_at_each_time(made, each=250)
    assert first.rdd.getNumPartitions() == 16 and sorted(first.collect()) == sorted(align.first_at_each_time(made).collect())
    assert sorted(align.align(made, each=250).collect()) == sorted(align.align(made).collect())


def test_signals_are_dealt_out_whole_where_items_are_small(spark, monkeypatch):
    """Else merging would count a signal once in every partition that has one of its bins, which grows with the partitions."""
    held, merged = [], align.merge_compatible
    monkeypatch.setattr(align, "merge_compatible", lambda means: held.append(means) or merged(means))
    made = rows(spark, [r for k in range(600) for r in item(f"i{k}", k, [(t, 0.1 * t) for t in range(12)])])
    found = align.align(made, each=200)
    at = {(r["data_id"], r["metric"], r["file"]) for r in held[0].withColumn("file", F.input_file_name()).collect()}
    assert len({f for *_, f in at}) > 30 and len(at) == 600
    assert sorted(found.collect()) == sorted(align.align(made).collect())


@pytest.mark.parametrize("most", [50, 3000])
def test_means_of_many_rows_are_dealt_out_and_crowded_groups_in_shares(spark, monkeypatch, most):
    sizes = []

    def watched(*args):
        out = dealt(*args)
        sizes.append(max(map(len, out.rdd.glom().collect())))
        return out

    monkeypatch.setattr(exact, "dealt", watched)
    data = [("crowd" if most > 50 else str(i % 60), i, (None, 0.1, 0.34, -1e14, float("nan") if i > 2900 else 1.7)[i % 5]) for i in range(3000)] + [("empty", 0, None)]
    df = spark.createDataFrame(data, "k string, t int, value double")
    exps = exact.exponents(df)
    found = exact.means(df, ["k"], exps, rows=3001, most=most, by=("t",), each=100)
    assert sizes and max(sizes) < 500 and found.rdd.getNumPartitions() == 31
    assert sorted(map(repr, found.collect())) == sorted(map(repr, exact.means(df, ["k"], exps).collect()))

"""Sums, medians and scans that must not depend on how rows are dealt out, against plain Python."""

import math
import random
from fractions import Fraction
from statistics import median

import pytest
from pyspark.sql import functions as F

from growth_spark.functions import exact
from growth_spark.operators import align
from growth_spark.plans import segments

COLUMNS = "data_id string, domain string, item_pos int, seq bigint, time_us bigint, metric string, value double"


def nearest(values):
    return float(sum(map(Fraction, values)) / len(values))


def groups(rng):
    yield "ordinary", [rng.uniform(-5, 5) for _ in range(300)]
    yield "fractions", [0.1, 0.2, 0.3, 0.34, 1.7] * 40
    yield "one value", [0.34] * 7
    yield "cancel", [1e16, 1.0, -1e16, 3.0, -1.0]
    yield "small", [rng.random() * 1e-12 for _ in range(50)]
    yield "large", [rng.random() * 1e14 for _ in range(50)]
    yield "negative", [-0.1] * 11
    yield "zeros", [0.0, -0.0]


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_means_are_the_nearest_doubles_for_any_partitioning(spark, parts):
    rng = random.Random(parts)
    rows = [(k, v) for k, values in groups(random.Random(1)) for v in values] + [("null", None), ("ordinary", None), ("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, value double").repartition(parts)
    found = {r["k"]: r["value"] for r in exact.means(df, ["k"], exact.exponents(df)).collect()}
    for k, values in groups(random.Random(1)):
        assert found[k] == nearest(values), k
    assert found["null"] is None and math.isnan(found["nan"]) and found["inf"] == math.inf


def test_means_of_the_ends_of_doubles(spark):
    values = {"tiny": [5e-324, 1e-320, 0.0], "huge": [1.7e308, 1.6e308, -1.7e308], "mixed": [1e300, 5e-324]}
    df = spark.createDataFrame([(k, v) for k, own in values.items() for v in own], "k string, value double")
    found = {r["k"]: r["value"] for r in exact.means(df, ["k"], exact.exponents(df)).collect()}
    assert found == {k: nearest(own) for k, own in values.items()}
    empty = df.limit(0)
    assert exact.exponents(empty) == [0] and exact.means(empty, ["k"], [0]).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("parts", [1, 4, 64])
def test_items_with_equal_rows_merge(spark, parts, adaptive):
    rng = random.Random(7)
    series = [(t, rng.choice([0.1, 0.34, 0.7, 1 / 3, 1e-9, 12345.678])) for t in range(0, 4000, 130)]
    rows = [(name, "d", pos, i, int(t * 1000), "m", v) for pos, name in enumerate("abc") for i, (t, v) in enumerate(series)]
    rows += [(name, "d", pos, i, int(t * 1000), "n", v + (pos == 2) * 1e-12) for pos, name in enumerate("abc") for i, (t, v) in enumerate(series)]
    rng.shuffle(rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(min(parts, 8)))
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        df = spark.createDataFrame(rows, COLUMNS).repartition(parts)
        found = align.align(df).groupBy("metric").agg(F.collect_set("data_id").alias("ids")).collect()
        assert {r["metric"]: set(r["ids"]) for r in found} == {"m": {"shared"}, "n": {"a", "b", "c"}}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_medians_by_narrowing(spark, most):
    rng = random.Random(3)
    data = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [7.0] * 300, "c": [rng.choice([1.0, 2.0, 1e300]) for _ in range(400)], "d": [3.0], None: [rng.random() for _ in range(90)]}
    rows = [(k, v) for k, own in data.items() for v in own] + [("e", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    assert {r["k"]: r["m"] for r in segments.medians(df, ["k"], "v", most).collect()} == {k: median(own) for k, own in data.items()}
    assert [r["m"] for r in segments.medians(df, [], "v", most).collect()] == [median([v for _, v in rows if v is not None])]
    assert segments.medians(df.filter("v IS NULL"), ["k"], "v", most).count() == 0


def long_item(rng, name, n, metric="m"):
    times = rng.sample(range(n * 4), n)
    return [(name, "d", 0, i, t * 1_000_000, metric, float(i)) for i, t in enumerate(times)]


def test_gaps_and_step_of_long_items(spark):
    """One item holds most rows, and it is cut into many blocks."""
    rng = random.Random(5)
    rows = long_item(rng, "hot", 1500) + long_item(rng, "b", 30) + long_item(rng, "c", 2) + long_item(rng, "d", 1)
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert align.cuts(df, align.ITEM, "time_us", 100)
    plain, cut = ({(r["data_id"], r["time_us"], r["gap"]) for r in align.gaps(df, most).collect()} for most in (1 << 20, 100))
    assert plain == cut and len(plain) == 1499 + 29 + 1
    assert align.step(df, 1 << 20).collect() == align.step(df, 50).collect()


def test_interpolation_of_long_signals(spark):
    rng = random.Random(8)
    rows = [("hot", i * 10, None if rng.random() < 0.7 else rng.random()) for i in range(1200)]
    rows += [("hot2", i * 10, 2.0 if i == 3 else None) for i in range(1000)] + [("none", i * 10, None) for i in range(300)]
    rows += [("b", i * 10, None if i % 5 else float(i)) for i in range(40)] + [(None, i * 10, None if i % 3 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "signal string, bin_us bigint, value double").repartition(5)
    for limit in (1, 4, 2000):
        plain, cut = (sorted(map(tuple, align.interpolate(df, ["signal"], limit, most=most).collect()), key=repr) for most in (1 << 20, 64))
        assert plain == cut
    held = {r["bin_us"]: r["value"] for r in align.interpolate(df.filter("signal = 'hot2'"), ["signal"], 500, most=64).collect()}
    assert [held[i * 10] for i in (2, 3, 503, 504)] == [None, 2.0, 2.0, None]

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from growth_spark import queries
from growth_spark.functions import masks
from growth_spark.operators import laue, linking, pattern, stats, symmetry
from growth_spark.plans import tables

NODE = "data_id string, seq bigint, node_id bigint, centroid_0 double, centroid_1 double, relative_centroid_1 double, intensity_centroid_1 double, specular_origin_1 double, bbox_minr int, bbox_minc int, bbox_maxr int, bbox_maxc int"


def node(image, i, c0, c1, plane, half=2):
    return (image, i, i, float(c0), float(c1), float(c1 - plane), float(c1 - plane), float(plane), c0 - half, c1 - half, c0 + half, c1 + half)


def test_mirror_pairs_merge_to_symmetric_nodes(spark):
    df = spark.createDataFrame([node("a", 0, 10, 20, 20), node("a", 1, 30, 5, 20), node("a", 2, 30, 35, 20), node("b", 0, 10, 3, 10)], NODE)
    found, edges = symmetry.symmetrised(df)
    a = sorted((r["centroid_0"], r["centroid_1"]) for r in found.filter("data_id = 'a'").collect())
    assert a == [(10.0, 20.0), (30.0, 5.0), (30.0, 35.0)]
    b = sorted((r["node_id"], r["centroid_1"]) for r in found.filter("data_id = 'b'").collect())
    assert b == [(0, 3.0), (1000, 17.0)]
    assert edges.filter("data_id = 'a'").count() == 3


def test_chain_of_boxes_needs_two_passes(spark):
    df = spark.createDataFrame([node("a", 0, 0, 0, 100), node("a", 1, 3, 0, 100), node("a", 2, 6, 0, 100)], NODE).filter("true")
    one = symmetry.merge_pass(df)
    assert one.count() == 2 and symmetry.merge_pass(one).count() == 1


def test_empty_patterns(spark):
    found, edges = symmetry.symmetrised(spark.createDataFrame([], NODE))
    assert found.count() == 0 and edges.count() == 0


def test_high_ids_are_numbered_on(spark):
    df = spark.createDataFrame([node("a", i, 100 * k, 0, 5) for k, i in enumerate((0, 7, 1003, 2001, 1000))], NODE)
    assert sorted(r["node_id"] for r in symmetry.merge_pass(df).collect()) == [0, 7, 8, 9, 1000]


def test_edges_touching_and_equal_left_edges(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 0.0, 0, 4), ("a", 2, 3.0, 4.0, 0, 2), ("a", 3, 0.0, 9.0, 4, 9)], "data_id string, node_id bigint, centroid_0 double, centroid_1 double, bbox_minc int, bbox_maxc int")
    found = {(r["start_node"], r["end_node"]): (r["weight"], r["horizontal_overlap"]) for r in pattern.edges(df).collect()}
    assert found[1, 2] == (5.0, True) and found[1, 3][1] is False and len(found) == 3


def test_overlap_with_and_without_cells(spark):
    rng = np.random.default_rng(1)
    data = []
    for i in range(60):
        r, c = (int(x) for x in rng.integers(0, 50, 2))
        data.append(("a", i, r, c, r + int(rng.integers(0, 9)), c + int(rng.integers(0, 9))))
    df = spark.createDataFrame(data, "data_id string, seq bigint, minr int, minc int, maxr int, maxc int")
    plain = {(r["a"], r["b"]) for r in pattern.overlapping(df).collect()}
    assert {(r["a"], r["b"]) for r in pattern.overlapping(df, cell=5).collect()} == plain
    expected = {(a[1], b[1]) for a, b in itertools.product(data, data) if a[2] <= b[4] and b[2] <= a[4] and a[3] <= b[5] and b[3] <= a[5]}
    assert plain == expected
    for cell, few in ((1, 0), (4, 0), (100, 0), (0.5, 59), (3, 60)):
        rows = pattern.overlapping(df, cell, few).collect()
        assert {(r["a"], r["b"]) for r in rows} == expected and len(rows) == len(expected)


def test_overlap_of_boxes_of_all_sizes_is_found_once(spark):
    rng = np.random.default_rng(4)
    data = []
    for image in "abc":
        for i in range(300 if image == "a" else 20):
            r, c = rng.uniform(-500, 500, 2)
            h, w = 2.0 ** rng.uniform(-3, 9, 2)
            data.append((image, i, r, c, r + h, c + w))
    data += [("d", i, 1.0, 1.0, 1.0, 1.0) for i in range(80)] + [("d", 90, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame([tuple(x if x is None or isinstance(x, (str, int)) else float(x) for x in r) for r in data], "data_id string, seq bigint, minr double, minc double, maxr double, maxc double")
    found = [tuple(r) for r in pattern.overlapping(df).collect()]
    whole = [r for r in data if None not in r]
    expected = {(a[0], a[1], b[1]) for a, b in itertools.product(whole, whole) if a[0] == b[0] and a[2] <= b[4] and b[2] <= a[4] and a[3] <= b[5] and b[3] <= a[5]}
    assert set(found) == expected and len(found) == len(expected)


def test_a_pass_over_cells_is_the_pass_over_all_pairs(spark):
    rng = np.random.default_rng(9)
    data = [node("a", i, *(int(x) for x in rng.integers(0, 90, 2)), 45) for i in range(150)]
    df = spark.createDataFrame(data, NODE)
    one, other = (sorted(map(tuple, symmetry.merge_pass(df, few).select("node_id", *symmetry.BOX).collect())) for few in (0, 1000))
    assert one == other and len(one) < 150


def test_normalised_columns(spark):
    df = spark.createDataFrame([("a", "f", 1, 1.0), ("b", "f", 1, 3.0), ("a", "g", 1, 5.0)], "data_id string, feature string, node_id bigint, value double")
    found = {(r["data_id"], r["feature"]): r["value"] for r in pattern.normalised(df).collect()}
    assert found["a", "f"] == pytest.approx(-found["b", "f"]) and found["a", "g"] is None
    assert {r["feature"] for r in pattern.streamlined(df).collect()} == {"f"}


def test_collection_errors_and_order(spark):
    images = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "pos int, data_id string")
    extra = spark.createDataFrame([(0, 5), (1, 1), (2, 5)], "pos int, key int")
    found = pattern.collection(images, extra, "key").collect()
    assert [(r["data_id"], r["pattern_id"]) for r in found] == [("y", 1), ("x", 0), ("z", 2)]
    with pytest.raises(ValueError):
        pattern.collection(images, extra.filter("pos > 0"))
    with pytest.raises(KeyError):
        pattern.collection(images, extra, "none")
    assert pattern.at(images, 1, 3).count() == 2


def test_masks(spark):
    df = spark.createDataFrame([("a", [2, 3, 1, 2], 4, 3), ("b", [0, 5], 4, 3), ("c", [], 4, 3), ("d", None, 4, 3)], "data_id string, mask_rle array<bigint>, mask_height int, mask_width int")
    runs = masks.runs_of(df, ["data_id"])
    assert sorted((r["data_id"], r["start"], r["end"]) for r in runs.collect()) == [("a", 2, 5), ("a", 6, 8), ("b", 0, 5)]
    mirrored = masks.reflect(runs.withColumn("o", F.lit(1)), ["data_id"], "o")
    pixels = {(r["data_id"], p) for r in mirrored.collect() for p in range(r["start"], r["end"])}
    expected = {(d, (2 - p // 4) * 4 + p % 4) for d, s, e in (("a", 2, 5), ("a", 6, 8), ("b", 0, 5)) for p in range(s, e)}
    assert pixels == expected
    once = masks.union(runs, ["data_id"])
    assert sorted(map(tuple, masks.union(once, ["data_id"]).collect())) == sorted(map(tuple, once.collect()))


def test_assignment_is_optimal():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (3, 4), (5, 5), (4, 7)):
        cost = rng.random((n, m))
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        assert sum(cost[i, j] for i, j in linking.assign(cost)) == pytest.approx(best)


def link_frames(rows, reach):
    """Track numbers of a whole collection followed at once, in order of their first points."""
    rows = rows.sort_values("frame", kind="stable").reset_index(drop=True)
    starts, known = [], {}
    for frame, image in rows.groupby("frame"):
        found, known = linking.follow(known, frame, image.index.to_numpy(), image[["x", "y"]].to_numpy(float), reach)
        starts += found.tolist()
    return [sorted(set(starts)).index(s) for s in starts]


def test_links_have_a_memory_of_one_image():
    rows = pd.DataFrame([(0, 0.0, 0.0), (1, 0.1, 0.0), (2, 9.0, 9.0), (3, 0.2, 0.0), (6, 0.2, 0.0)], columns=["frame", "x", "y"])
    assert link_frames(rows, 1.0) == [0, 0, 1, 0, 2]


def test_links_take_the_least_total():
    rows = pd.DataFrame([(0, 0.0, 0.0), (0, 1.0, 0.0), (1, 0.8, 0.0), (1, 1.6, 0.0)], columns=["frame", "x", "y"])
    assert link_frames(rows, 1.0) == [0, 1, 0, 1]


def test_links_by_groups_equal_those_of_whole_collections(spark):
    rng = np.random.default_rng(11)
    rows = []
    for collection, n in (("big", 40), ("small", 4), (None, 5)):
        for frame in range(n):
            rows += [(collection, f"{collection}-{frame}", i, i, frame, *map(float, rng.random(2) * 12), 1.5) for i in range(int(rng.integers(0, 12)))]
    rows.append(("big", "lost", 0, 0, 41, None, None, 1.5))
    kind = "collection_id string, data_id string, node_id bigint, seq int, frame int, x double, y double, reach double"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # images go on from batch to batch
    found = {(r["collection_id"], r["data_id"], r["node_id"]): r["linked_id"] for r in linking.linked(spark.createDataFrame(rows, kind)).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(rows)
    frame = pd.DataFrame(rows, columns=["collection", "data", "node", "seq", "frame", "x", "y", "reach"])
    for collection, own in frame.groupby("collection", dropna=False):
        own = own.sort_values(["frame", "seq"])
        ids = link_frames(own, 1.5)
        key = None if pd.isna(collection) else collection
        assert [found[key, d, n] for d, n in zip(own["data"], own["node"], strict=True)] == [i + 1 for i in ids]
    assert linking.linked(spark.createDataFrame([], kind)).collect() == []


def test_rows_are_numbered_across_partitions(spark):
    rows = tables.numbered(spark.range(1000).repartition(7).select((F.col("id") % 500).alias("v"), "id"), [F.desc("v"), "id"], "at", 1)
    assert [(r["v"], r["id"]) for r in rows.orderBy("at").collect()] == sorted(((i % 500, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert sorted(r["at"] for r in rows.collect()) == list(range(1, 1001))


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(900, 901), (901, 900), (950, 950)], "a bigint, b bigint"))
    found = {r["node"]: r["root"] for r in tables.components(chain, "chain").collect()}
    assert found == {**dict.fromkeys(range(201), 0), 900: 900, 901: 900, 950: 950}


def test_laue_radius_of_a_drawn_circle(spark):
    image = np.zeros((60, 60))
    for t in np.linspace(0, 2 * np.pi, 4000):
        y, x = round(20 * np.sin(t) + 25), round(20 * np.cos(t) + 30)
        image[y, x] = 100
    images = spark.createDataFrame([("a", image.ravel().tolist(), 60)], "data_id string, image array<double>, width int")
    points = spark.createDataFrame([("a", 45.0, 30.0)], "data_id string, cy double, cx double")
    scored = laue.scores(images, points, 41, 360, 10.0, 30.0)
    by = {round(r["radius"], 1): r["score"] for r in scored.collect()}
    assert by[20.0] == 100
    found = laue.best_radius(scored.filter("radius < 20.2"), points, best=1).first()
    assert found["radius"] == pytest.approx(20) and found["cy"] == 45 - found["radius"]


def plain_scores(image, cy, cx, radii, angles, low, high):
    """Pixel by pixel with numpy's own quantile."""
    out = {}
    for r in np.linspace(low, high, radii):
        theta = np.linspace(0, 2 * np.pi, angles)
        x, y = np.rint(r * np.cos(theta) + cx).astype(int), np.rint(r * np.sin(theta) + cy - r).astype(int)
        on = (x >= 0) & (y >= 0) & (x < image.shape[1]) & (y < image.shape[0])
        values = image[y[on], x[on]]
        values = values[~np.isnan(values)]
        if len(values):
            out[round(float(r), 9)] = float(np.quantile(values, 0.9))
    return out


def test_laue_scores_against_a_plain_version(spark):
    rng = np.random.default_rng(2)
    image = rng.random((90, 70))
    image[rng.random((90, 70)) < 0.1] = np.nan
    missing = [None if v != v else float(v) for v in image.ravel()]
    images = spark.createDataFrame([("a", missing, 70), ("none", None, 70), ("empty", [], 70), ("apart", missing, 70)], "data_id string, image array<double>, width int")
    points = spark.createDataFrame([("a", 33.3, 20.7), ("none", 1.0, 1.0), ("empty", 1.0, 1.0), ("apart", 1e6, 1e6), ("nowhere", 1.0, 1.0)], "data_id string, cy double, cx double")
    found = laue.scores(images, points, 300, 181, 3.1, 61.7).collect()
    assert {r["data_id"] for r in found} == {"a"}
    want = plain_scores(image, 33.3, 20.7, 300, 181, 3.1, 61.7)
    assert {round(r["radius"], 9): r["score"] for r in found} == pytest.approx(want)


def test_laue_radius_from_nodes_at_full_size(spark):
    """2000 radii of 1440 angles on an image of 900 by 800 pixels, the point from the symmetrised nodes."""
    image = np.zeros((900, 800), np.float32)
    t = np.linspace(0, 2 * np.pi, 20_000)
    for r in (299.5, 300.0, 300.5):
        y, x = np.rint(r * np.sin(t) + 700 - r).astype(int), np.rint(r * np.cos(t) + 390).astype(int)
        image[y, x] = 50
    images = spark.createDataFrame([(name, image.ravel().tolist(), 800) for name in "ab"], "data_id string, image array<float>, width int")
    schema = NODE + ", intensity_centroid_0 double, specular_origin_0 double"
    nodes = [(*node(name, 0, 300, 390, 390), 100.0, 600.0) for name in "ab"] + [(*node("a", 1, 310, 200, 390), 5.0, 600.0), (*node("c", 0, 3, 4, 5), 1.0, 1.0)]
    found = {r["data_id"]: r for r in laue.zero_radius(spark.createDataFrame(nodes, schema), images).collect()}
    assert set(found) == {"a", "b"}
    for r in found.values():
        assert abs(r["radius"] - 300) < 3 and r["cy"] == 700 - r["radius"] and r["cx"] == 390


def test_duplicate_features_keep_the_first_name(spark):
    df = spark.createDataFrame([(r, f, v) for r in range(3) for f, v in (("b", r * 1.0), ("a", r * 1.0), ("c", 2.0))], "row int, feature string, value double")
    assert {r["feature"] for r in stats.without_duplicate_features(df).collect()} == {"a", "c"}


def test_positions_sizes_and_keys_of_a_collection(spark):
    images = spark.createDataFrame([("c", i, f"d{i}", 10 + i, 30 - i, {"a": 1, f"k{i % 2}": 2} if i else None) for i in range(5)], "collection_id string, pos int, data_id string, image_width int, image_height int, extra map<string,int>")
    ids = lambda *x: [r["pos"] for r in pattern.at(images, *x).orderBy("pos").collect()]
    assert ids(1, 3) == [1, 2] and ids(2) == [2] and ids(-1) == [4] and ids(-2, 5) == [3, 4] and ids(0, -3) == [0, 1] and ids(-9, 2) == [0, 1] and ids(3, 9) == [3, 4]
    for wrong in (5, -6):
        with pytest.raises(IndexError):
            pattern.at(images, wrong)
    assert pattern.length(images) == 5 and pattern.length(images.limit(0)) == 0
    assert tuple(pattern.largest_size(images).first()) == ("c", 14, 30)
    assert sorted(r["key"] for r in pattern.extra_keys(images).collect()) == ["a", "k0", "k1"]


def test_tasks_of_masks_and_edges_do_not_grow_with_the_table(spark):
    """Partitions are as many as the rows ask for, and pairs are not hashed again behind the join."""
    runs = spark.range(400).select(F.col("id").alias("data_id"), F.lit(3).alias("start"), F.lit(12).alias("end"), F.lit(8).alias("mask_height"), F.lit(8).alias("mask_width"), F.lit(4).alias("origin"))
    small = masks.reflect(runs, ["data_id"], "origin", each=50)
    assert small.rdd.getNumPartitions() == 16 and sorted(small.collect()) == sorted(masks.reflect(runs, ["data_id"], "origin").collect())
    nodes = spark.range(400).select(F.floor(F.col("id") / 4).alias("data_id"), (F.col("id") % 4 % 3).alias("node_id"), *[F.lit(1.0).alias(c) for c in ("centroid_0", "centroid_1")], F.lit(1).alias("bbox_minc"), F.lit(4).alias("bbox_maxc"))
    found = pattern.edges(nodes, each=50)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") and "Repartition" in plan
    assert found.rdd.getNumPartitions() == 8 and sorted((r["data_id"], r["start_node"], r["end_node"]) for r in found.collect()) == [(d, a, b) for d in range(100) for a, b in ((0, 1), (0, 2), (1, 2))]


def test_symmetrised_rounds_as_its_sql(spark, tmp_path):
    """Centres whose ninth digit is a half, or next to one, in the double or in its shortest decimal only."""
    duckdb = pytest.importorskip("duckdb")
    values = [25942.427187499998, 8569.5909375, 68140.5739375, 89715.232187499999, 29457.375312499998, 1.0, 0.0]
    lines = pd.DataFrame({"l_orderkey": range(len(values)), "l_linenumber": 1, "l_partkey": 1, "l_quantity": 5.0, "l_extendedprice": values, "l_discount": 0.1, "l_tax": 0.1})
    lines.to_parquet(tmp_path / "lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet')")
    found = queries.QUERIES["symmetrised"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(queries.ORACLE_SQL["symmetrised"]).fetchall())


def test_merged_centres_do_not_depend_on_the_order_of_nodes(spark):
    """A centre is its nodes' exact sum, rounded, over their number, in whichever order they come."""
    centres = [2.0**53, 1.0, 1.0, 0.1, 1.0, 1.0, -(2.0**53)]
    one = math.fsum(centres) / len(centres)
    data = [(*node("a", i, 10, 20, 20)[:3], c, *node("a", i, 10, 20, 20)[4:]) for i, c in enumerate(centres)]
    for rows in (data, data[::-1], data[3:] + data[:3]):
        assert [r["centroid_0"] for r in symmetry.merge_pass(spark.createDataFrame(rows, NODE)).collect()] == [math.fsum([one] * len(centres)) / len(centres)]


def test_small_images_are_symmetrised_without_joins(spark, monkeypatch):
    """One task merges an image as the joins do, masks, missing sides, repeated ids and long chains too; nothing is written."""
    rng = np.random.default_rng(8)
    data = []
    for image, n in [*((f"i{k}", int(rng.integers(1, 9))) for k in range(25)), ("many", 40), (None, 2), ("none", 2)]:
        for i in range(n):
            r, c = (int(x) for x in rng.integers(0, 40, 2))
            own = list(node(image, i, r, c, 19.5, 3))
            own[2] = (i, i // 2, 995 + 5 * i)[int(rng.integers(0, 3))]
            own[3:5] = float(rng.normal() * 10), (None, 19.5, float(c))[int(rng.integers(0, 9)) // 4 if i else 2]
            own[8:] = [None if image == "none" or rng.random() < 0.02 else x for x in own[8:]]
            start = int(rng.integers(0, 1500))
            data.append((*own, None if rng.random() < 0.2 else float(i), f"p{i}", 40, 40, None if rng.random() < 0.2 else [(start, start + int(rng.integers(1, 90)))]))
    chain = [(*node("chain", i, 3 * i, 0, 100), 1.0, "p", 40, 40, []) for i in range(5)]
    nodes = spark.createDataFrame(data + chain, NODE + ", area double, pattern_id string, mask_width int, mask_height int, runs array<struct<start:bigint,end:bigint>>").repartition(3)
    columns = ["data_id", "node_id", "seq", "centroid_0", "centroid_1", *symmetry.BOX, "pattern_id", "mask_width", "runs", "area", "intensity_centroid_1"]
    rows = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    joined, _ = symmetry.symmetrised(nodes, whole=2)
    want = rows(joined)
    monkeypatch.setattr(symmetry, "cut", lambda *_: pytest.fail("a pass is written"))
    found, edges = symmetry.symmetrised(nodes)
    one = rows(found)
    assert [r[:-2] for r in one] == [r[:-2] for r in want] and len(one) > 100
    assert all((x is None) == (y is None) and (x is None or x == pytest.approx(y)) for r, w in zip(one, want, strict=True) for x, y in zip(r[-2:], w[-2:], strict=True))
    assert {r["data_id"] for r in edges.collect()} <= {r[0] for r in want} and found.schema["runs"] == joined.schema["runs"]
    with pytest.raises(Exception, match="did not settle"):
        symmetry.symmetrised(nodes, passes=1)[0].collect()


def test_symmetrised_shuffles_its_nodes_once(spark, tmp_path, monkeypatch):
    """Line items are dealt out by their order before they are nodes, in partitions that follow their number, and stay there."""
    lines = pd.DataFrame({"l_orderkey": np.arange(600) // 4, "l_linenumber": np.arange(600, dtype=np.int32) % 4, "l_partkey": 1, "l_quantity": np.arange(600) % 50 + 1.0, "l_extendedprice": np.arange(600) * 37.5, "l_discount": 0.1, "l_tax": 0.1})
    lines.to_parquet(tmp_path / "lineitem.parquet")
    usual = sorted(map(tuple, queries.QUERIES["symmetrised"](spark, str(tmp_path)).collect()))
    monkeypatch.setattr(queries, "dealt", lambda df, keys, rows: tables.dealt(df, keys, rows, each=50))
    found = queries.QUERIES["symmetrised"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and found.rdd.getNumPartitions() == 12 and sorted(map(tuple, found.collect())) == usual


def test_small_collections_are_linked_without_joins(spark, monkeypatch):
    """The numbers are those of the way by groups of candidates; rows without an image, a place or a collection have theirs."""
    rng = np.random.default_rng(5)
    rows = [(c, f"{c}-{f}", i, i % 3, f, *map(float, rng.random(2) * 8), 1.5) for c in ("a", "b", None) for f in range(12) for i in range(int(rng.integers(1, 7)))]
    rows += [(c, f"{c}-{f}", 9, 1, f, *at, 1.5) for c in ("a", None) for f, at in ((3, (None, 1.0)), (4, (math.nan, 1.0)), (None, (2.0, 2.0)))] + [("c", "c-0", 0, 0, 0, 1.0, 1.0, None), ("c", "c-1", 0, 0, 1, 1.0, 1.0, None)]
    nodes = spark.createDataFrame(rows, "collection_id string, data_id string, node_id bigint, seq int, frame int, x double, y double, reach double").coalesce(1)
    by_groups = sorted(linking.linked(nodes, whole=0).collect(), key=str)
    mixed = sorted(linking.linked(nodes, whole=50, image=6).collect(), key=str)
    monkeypatch.setattr(tables, "components", lambda *_: pytest.fail("candidates are joined"))
    assert sorted(linking.linked(nodes).collect(), key=str) == by_groups == mixed and len(by_groups) == len(rows)

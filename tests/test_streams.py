"""State by item and the chunk store: any cut of the batches, restarts, batches that run again, faults."""

import random

import pytest
from pyspark.sql import functions as F

from growth_spark.streaming import chunk_store, items

SCHEMA = "user string, t bigint, kind string, value double"


def events(n=240, seed=3):
    rng = random.Random(seed)
    return sorted(((rng.choice("aaaabc"), i, rng.choice(["x", "y", None]), rng.choice([None, rng.random()])) for i in range(n)), key=lambda r: r[1])


def fed(spark, tmp_path, rows, cut):
    """A stream that takes the rows a batch each, as they are cut."""
    own = items.session(spark)
    path = str(tmp_path / "in")
    for k, (a, b) in enumerate(zip([0, *cut], [*cut, len(rows)], strict=True)):
        if a < b:
            spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/b={k}")
    return own.readStream.schema(SCHEMA + ", b int").option("maxFilesPerTrigger", 1).parquet(path).drop("b")


def run(df, tmp_path, name):
    """All batches; what they emitted, with the number of the batch."""
    out = str(tmp_path / f"{name}-out")

    def sink(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/n={number}")

    df.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / f"{name}-check")).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    return [tuple(r) for r in df.sparkSession.read.parquet(out).drop("n").orderBy("batch").collect()]


CUTS = [[], [1, 2, 100], [60, 61, 62, 180], list(range(40, 240, 40))]


@pytest.mark.parametrize("cut", CUTS)
def test_last_rows_of_each_item_in_any_cut(spark, tmp_path, cut):
    rows = events()
    found = run(items.follow(fed(spark, tmp_path, rows, cut), ["user"], ["t"], 5), tmp_path, "last")
    for user in "abc":
        polls = max(r[4] for r in found if r[0] == user)
        last = [r[:4] for r in found if r[0] == user and r[4] == polls]
        assert sorted(last, key=lambda r: r[1]) == [r for r in rows if r[0] == user][-5:]


@pytest.mark.parametrize("cut", CUTS)
def test_changes_in_any_cut_are_those_of_the_whole(spark, tmp_path, cut):
    rows = events()
    found = run(items.changes(fed(spark, tmp_path, rows, cut), ["user"], ["t"], ["kind"]), tmp_path, "changes")
    want = []
    for user in "abc":
        own = [r for r in rows if r[0] == user]
        want += [r for k, r in enumerate(own) if k == 0 or r[2] != own[k - 1][2]]
    assert sorted(map(repr, (r[:4] for r in found))) == sorted(map(repr, want))


def test_rules_hold_by_item(spark, tmp_path):
    """Keys that come back pass, suppressed polls count, an item that has ended lets the others go on."""
    rows = [("a", i, k, 0.0) for i, k in enumerate("xxyx")] + [("b", i + 10, "z", 1.0) for i in range(4)]
    batches = [rows[0::4], rows[1::4], rows[2::4], rows[3::4]]
    flat = [r for b in batches for r in b]
    found = run(items.follow(fed(spark, tmp_path, flat, [2, 4, 6]), ["user"], ["t"], 1, distinct_by=lambda df: df["kind"].iloc[-1], until=lambda df: df["kind"].iloc[-1] == "z"), tmp_path, "rules")
    assert sorted((r[0], r[2], r[4]) for r in found) == [("a", "x", 1), ("a", "x", 4), ("a", "y", 3), ("b", "z", 1)]
    found = run(items.follow(fed(spark, tmp_path / "more", flat, [2, 4, 6]), ["user"], ["t"], 1, max_polls=2), tmp_path / "more", "polls")
    assert sorted((r[0], r[4]) for r in found) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    with pytest.raises(ValueError):
        items.follow(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), ["user"], ["t"], 0)


def test_state_survives_a_restart(spark, tmp_path):
    rows = events(80)
    stream = lambda: items.session(spark).readStream.schema(SCHEMA + ", b int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("b")
    spark.createDataFrame(rows[:50], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/b=0"))
    first = run(items.changes(stream(), ["user"], ["t"], ["kind"]), tmp_path, "again")
    spark.createDataFrame(rows[50:], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/b=1"))
    both = run(items.changes(stream(), ["user"], ["t"], ["kind"]), tmp_path, "again")
    want = []
    for user in "abc":
        own = [r for r in rows if r[0] == user]
        want += [r for k, r in enumerate(own) if k == 0 or r[2] != own[k - 1][2]]
    assert len(first) < len(both) and sorted(map(repr, (r[:4] for r in both))) == sorted(map(repr, want))


# --- chunks -------------------------------------------------------------------------------------------------------------

CHUNK = "data_id string, chunk_idx int, dims string, frames binary, start_unix_ms_utc bigint, fps double"


def chunk(name, idx, fill, dims="2,2,3"):
    n = 1
    for x in dims.split(","):
        n *= int(x)
    return name, idx, dims, bytes([fill]) * n, 1000 * idx, 8.0


def kept(store):
    return {(r["data_id"], r["chunk_idx"]): (bytes(r["frames"])[0], r["version"]) for r in store.read().collect()}


def test_the_last_version_of_a_chunk_stands(spark, tmp_path):
    store = chunk_store.ChunkStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    put = lambda *rows: store.push(spark.createDataFrame(list(rows), CHUNK))
    put(chunk("a", 0, 1), chunk("a", 1, 1), chunk("b", 0, 1))
    assert put(chunk("a", 1, 2), chunk("a", 2, 2)) == 1
    assert kept(store) == {("a", 0): (1, 0), ("a", 1): (2, 1), ("a", 2): (2, 1), ("b", 0): (1, 0)}
    store.write(spark.createDataFrame([chunk("a", 1, 7)], CHUNK), 1)  # the same version again
    assert kept(store) == {("a", 0): (1, 0), ("a", 1): (7, 1), ("b", 0): (1, 0)}
    put(chunk("a", 0, 9), chunk("a", 0, 9))
    store.compact()
    assert store.versions() == [3] and {k: v for k, (v, _) in kept(store).items()} == {("a", 0): 9, ("a", 1): 7, ("b", 0): 1}
    row = store.read().filter("chunk_idx = 1").first()
    assert (row["key"], row["dims"], row["end_unix_ms_utc"]) == ("frames.zarr/frames/c/1/0/0", "2,2,3", 1250)
    put(chunk("c", 0, 5, "4,5"))
    assert store.read().filter("data_id = 'c'").first()["dims"] == "1,4,5"


@pytest.mark.parametrize("bad", [("a", 0, "2", b"ab", 0, 8.0), ("a", 0, "1,2,3,4", b"a" * 24, 0, 8.0), ("a", 0, None, b"ab", 0, 8.0), ("a", 0, "2,2,2", b"abc", 0, 8.0), ("a", None, "1,1", b"a", 0, 8.0), ("a", 0, "1,1", None, 0, 8.0)])
def test_a_fault_commits_nothing(spark, tmp_path, bad):
    store = chunk_store.ChunkStore(spark, str(tmp_path / "store"))
    store.push(spark.createDataFrame([chunk("a", 0, 1)], CHUNK))
    with pytest.raises(Exception, match="frames|missing"):
        store.push(spark.createDataFrame([chunk("a", 1, 2), bad], CHUNK))
    assert store.versions() == [0] and kept(store) == {("a", 0): (1, 0)}


def test_a_stream_numbers_its_chunks_and_ends_at_the_first_fault(spark, tmp_path):
    own = items.session(spark)
    source = "data_id string, seq bigint, dims string, frames binary, start_unix_ms_utc bigint, fps double"
    store = chunk_store.ChunkStore(spark, str(tmp_path / "store"))

    def put(k, *rows):
        spark.createDataFrame([(d, s, dims, bytes([s]) * n, s, 8.0) for d, s, dims, n in rows], source).coalesce(1).write.parquet(str(tmp_path / f"in/b={k}"))

    def go():
        stream = own.readStream.schema(source + ", b int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("b")
        query = chunk_store.numbered(stream, ["seq"]).writeStream.foreachBatch(store.sink()).option("checkpointLocation", str(tmp_path / "check")).outputMode("update").trigger(availableNow=True).start()
        query.awaitTermination()

    put(0, ("a", 2, "1,2", 2), ("a", 1, "1,2", 2), ("b", 1, "2,1,2", 4))
    put(1, ("a", 3, "1,2", 2), ("b", 2, "1,2", 2))
    go()
    assert {k: v for k, (v, _) in kept(store).items()} == {("a", 0): 1, ("a", 1): 2, ("a", 2): 3, ("b", 0): 1, ("b", 1): 2}
    put(2, ("a", 4, "7", 7))
    with pytest.raises(Exception, match="two or three dimensions"):
        go()
    assert len(kept(store)) == 5


def test_an_item_needs_no_data_frame():
    """Rows come and go as rows: a frame for each item and poll takes longer than all else."""
    from pyspark.sql import Row

    class State:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    found = items.Changes(["t", "k"], ["t"], ["k"])
    found.last = State()
    assert [r.t for r in found.handleInputRows(None, iter([Row(t=3, k="b"), Row(t=1, k="a"), Row(t=None, k=None), Row(t=2, k="a")]), None)] == [1, 3, None]
    assert [r.t for r in found.handleInputRows(None, iter([Row(t=5, k=None), Row(t=6, k="b")]), None)] == [6]


def test_the_items_of_a_bucket_share_one_state():
    """One call to read and one to write serve all items of a batch; each item is compared with its own rows."""
    from pyspark.sql import Row

    calls = []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    found = items.Changes(["user", "t", "k"], ["t"], ["k"], ["user"])
    found.last = State()
    go = lambda *rows: [tuple(r) for r in found.handleInputRows(None, iter([Row(user=u, t=t, k=k) for u, t, k in rows]), None)]
    assert go(("a", 2, "x"), ("b", 1, "x"), ("a", 3, "x"), (None, 4, "x")) == [("b", 1, "x"), ("a", 2, "x"), (None, 4, "x")]
    assert go(("b", 5, "y"), ("a", 6, "x"), (None, 7, "x"), ("c", 8, "x")) == [("b", 5, "y"), ("c", 8, "x")]
    assert calls == ["get", "update"] * 2

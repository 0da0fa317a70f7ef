"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles. Documents with equal sets form a class (a node with a number of its
own, whatever the keys of its rows). A class keeps the ``K`` smallest of its shingles' hashes; inverted lists of these values generate
candidate pairs, the sketch of the union estimates their similarity and filters, and full sets confirm every link.

* A similar pair shares at least T retained values (with a chance of less than one in 10**9 to the contrary), so of each
  sketch the rarest K - T + 1 values are enough for the lists. Passages that many documents share are the most frequent
  values and so in no list of a document that has much else.
* In a list of up to ``ALL`` classes every pair is a candidate; in a longer one each class meets three pivots. The most
  similar candidates are confirmed first, linked classes are contracted to components, and only pairs of different
  components are left to confirm. Long lists that then still hold several components have their remaining pairs of
  different components compared (no link is lost, and a group of copies is never expanded into its pairs).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST, Scratch, documents, groups, key_of, map_batches, mark_of, prefix_hash, window_hash

SHINGLE, K, T = 5, 64, 27
#: Similarity of a link, in hundredths; estimates five standard deviations below it are dropped.
SIMILAR, ESTIMATE = 75, 0.48
ALL = 8
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOT = 1 << 18


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; of all its words, if they are fewer than five."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    # A shorter sequence is told from a five-word shingle by its length.
    return np.unique(window_hash(prefix_hash(codes), size).view(np.int64) ^ np.int64((SHINGLE - size) * 0x1F3D5B79))


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per row: doc, mark, n (set size), h1 and h2 (a 128-bit hash of the set) and sketch (its k smallest hashes, in order)."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for a, b in groups([len(t.as_buffer()) for t in batch["bytes"]], LOT * 8):
                sets = [shingles(t) for t in batch["bytes"][a:b].to_pylist()]
                halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
                yield {"doc": batch["doc"][a:b], "mark": batch["mark"][a:b], "n": list(map(len, sets)), "h1": halves[:, 0], "h2": halves[:, 1], "sketch": [s[:k] for s in sets]}

    return map_batches(documents(docs, key, text), body, "doc bigint, mark bigint, n bigint, h1 bigint, h2 bigint, sketch array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, own: the whole set) of the classes in ``wanted`` (node, doc, mark)."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for a, b in groups([len(t.as_buffer()) for t in batch["bytes"]], LOT * 8):
                yield {"node": batch["node"][a:b], "own": [shingles(t) for t in batch["bytes"][a:b].to_pylist()]}

    return map_batches(documents(docs, key, text).join(wanted, ["doc", "mark"]), body, "node bigint, own array<bigint>").dropDuplicates(["node"])


def listed(classes: DataFrame) -> DataFrame:
    """Entries of the inverted lists: (v, node, doc, n, central), of each sketch the rarest values that can't all be missed."""
    entries = classes.select("node", "doc", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    often = entries.groupBy("v").agg(F.count("*").alias("f")).filter("f > 1")
    # Values of one class only are the rarest of all; they need no entry but take their places.
    least = F.when(F.col("n") * 4 <= 3 * K, F.ceil(F.col("n") * (SIMILAR / 100))).otherwise(F.lit(T))
    shared = entries.join(often, "v").groupBy("node", "doc", "n", "size").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("values"))
    places = F.col("size") - least + 1 - (F.col("size") - F.size("values"))
    # How much of the sketch is shared, and how widely: greatest where no edit sets a copy apart from the others.
    central = F.aggregate("values", F.lit(0.0), lambda t, x: t + F.log(x["f"].cast("double"))) / F.col("size")
    indexed = shared.select("node", "doc", "n", central.alias("central"), F.explode(F.slice("values", 1, F.greatest(places, F.lit(0)).cast("int"))).alias("x"))
    return indexed.select(F.col("x.v").alias("v"), "node", "doc", "n", "central")


def near_sizes(a: str = "na", b: str = "nb") -> F.Column:
    return (F.col(a) * 100 >= F.col(b) * SIMILAR) & (F.col(b) * 100 >= F.col(a) * SIMILAR)


def candidate_pairs(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of short lists, and each class of a longer list with the list's pivots."""
    short, long_ = entries.join(sizes.filter(F.col("c") <= ALL), "v"), entries.join(sizes.filter(F.col("c") > ALL), "v")
    x, y = (short.select("v", F.col("node").alias(d), F.col("n").alias(m)) for d, m in (("a", "na"), ("b", "nb")))
    every = x.join(y, "v").filter(F.col("a") < F.col("b")).filter(near_sizes()).select("a", "b")
    pivot = F.struct(F.col("node").alias("p"), F.col("n").alias("np"))
    pivots = long_.groupBy("v").agg(F.array(F.min_by(pivot, F.struct("doc", "node")), F.max_by(pivot, F.struct("central", -F.col("doc"), -F.col("node"))), F.min_by(pivot, F.xxhash64("node"))).alias("pivots"))
    star = long_.join(pivots, "v").select("node", "n", F.explode("pivots").alias("x")).select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("x.p").alias("b"), F.col("x.np").alias("nb"))
    star = star.filter(F.col("a") != F.col("b")).filter(near_sizes()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return every.unionByName(star).distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs with the similarity that the sketch of their union estimates, where it is high enough."""
    x, y = (classes.select(F.col("node").alias(d), F.col("sketch").alias(s)) for d, s in (("a", "sa"), ("b", "sb")))
    both = pairs.join(x, "a").join(y, "b").withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K))
    share = F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb")) / F.size("u")
    return both.select("a", "b", share.alias("e")).filter(F.col("e") >= ESTIMATE)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar."""
    x, y = (sets.select(F.col("node").alias(d), F.col("own").alias(s)) for d, s in (("a", "sa"), ("b", "sb")))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").filter(common * 100 >= (F.size("sa") + F.size("sb") - common) * SIMILAR).select("a", "b")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by contraction of the graph in rounds."""
    edges = scratch.save(links.select("a", "b").distinct(), f"{name}-edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up"))
        for _ in range(2):  # each node points to its parent's parent
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = up.join(above, "up").select("node", F.col("top").alias("up"))
        up = scratch.save(up, f"{name}-up{turn}")
        labels = scratch.save(labels.join(up.select(F.col("node").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"{name}-labels{turn}")
        x, y = (up.select(F.col("node").alias(c), F.col("up").alias(u)) for c, u in (("a", "ua"), ("b", "ub")))
        edges = scratch.save(edges.join(x, "a").join(y, "b").filter("ua != ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), f"{name}-edges{turn}")
    return labels


def mixed(parts: DataFrame) -> DataFrame:
    """Entries of lists that hold several components."""
    return parts.join(parts.groupBy("v").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("v"), "v")


def missed(parts: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """All pairs (a, b) of different components among ``parts`` (node, n, root) that may be similar.

    Full sets are ordered by how few of these classes have a shingle, the rarest first. Of a similar pair the first
    common shingle stands among the first quarter of both, and what follows it is enough for the overlap that the two
    sizes ask for. So copies whose edits are too many for each other meet in no pair, however long the lists are.
    """
    inside = parts.join(sets, "node").select("node", "n", "root", F.explode("own").alias("v"))
    often = inside.groupBy("v").agg(F.count("*").alias("f")).filter("f > 1")
    shared = inside.join(often, "v").groupBy("node", "n", "root").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("values"))
    before = F.col("n") - F.size("values")  # shingles of this class alone come first
    places = F.floor(F.col("n") * (100 - SIMILAR) / 100) + 1 - before
    listed_ = shared.withColumn("before", before).select("node", "n", "root", "before", F.posexplode(F.slice("values", 1, F.greatest(places, F.lit(0)).cast("int"))).alias("at", "x"))
    rows = scratch.save(mixed(listed_.select(F.col("x.v").alias("v"), "node", "n", "root", (F.col("n") - F.col("before") - F.col("at")).alias("rest"))), "left")
    # Of a similar pair the one that asks no more of the other than its own size has the shingle among its first seventh,
    # or both had to be smaller than the other: so only entries that stand that far in front look for partners.
    ahead = F.col("rest") * (100 + SIMILAR) >= 2 * SIMILAR * F.col("n")
    x, y = (rows.select("v", F.col("node").alias(d), F.col("n").alias(m), F.col("root").alias(r), F.col("rest").alias(o), ahead.alias(f"f{d}")) for d, m, r, o in (("a", "na", "ra", "oa"), ("b", "nb", "rb", "ob")))
    enough = F.least("oa", "ob") * (100 + SIMILAR) >= (F.col("na") + F.col("nb")) * SIMILAR
    met = x.filter("fa").join(y, "v").filter((F.col("ra") != F.col("rb")) & (~F.col("fb") | (F.col("a") < F.col("b"))) & near_sizes() & enough)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose classes are in different components (a class without a link is one alone)."""
    x, y = (labels.select(F.col("node").alias(c), F.col("root").alias(r)) for c, r in (("a", "ra"), ("b", "rb")))
    return pairs.join(x, "a", "left").join(y, "b", "left").filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).drop("ra", "rb")


def clustered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: doc, mark, n and component (the smallest doc reachable over links)."""
    scratch = Scratch(docs.sparkSession, "near")
    rows = scratch.save(sketches(docs, key, text), "sketches")
    first = scratch.save(rows.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("doc", "mark")).alias("at")).select("at.doc", "at.mark"), "firsts")
    classes = rows.join(first, ["doc", "mark"], "left_semi").dropDuplicates(["doc", "mark"])
    classes = scratch.save(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbered once: they are read from here on
    entries = scratch.save(listed(classes), "entries")
    sizes = scratch.save(entries.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1"), "sizes")
    pairs = scratch.save(estimated(candidate_pairs(entries, sizes), classes), "pairs")

    # Full sets of all classes that a candidate pair or a long list has: one more reading of the texts, not several.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(entries.join(sizes.filter(F.col("c") > ALL).select("v"), "v").select("node")).distinct()
    sets = scratch.save(full_sets(docs, classes.select("node", "doc", "mark").join(wanted, "node"), key, text), "sets")

    # Of each class the most similar candidate first: most links between components come of these.
    ends = pairs.select("a", "b", "e").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "e"))
    best = ends.groupBy("a").agg(F.max_by("b", F.struct("e", -F.col("b"))).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    best = scratch.save(best, "best")
    links = scratch.save(confirmed(best, sets), "links1")
    labels = components(links, scratch, "first")
    rest = scratch.save(apart(pairs.join(best, ["a", "b"], "left_anti"), labels), "rest")
    if not rest.isEmpty():
        links = links.unionByName(scratch.save(confirmed(rest, sets), "links2"))
        labels = components(links, scratch, "second")
    # Long lists with several components: pairs of different components that no pivot has brought together.
    parts = entries.join(sizes.filter(F.col("c") > ALL).select("v"), "v").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = scratch.save(mixed(parts.select("v", "node", "n", "root")).select("node", "n", "root").distinct(), "parts")
    more = scratch.save(missed(parts, sets, scratch).join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        links = links.unionByName(scratch.save(confirmed(more, sets), "links3"))
        labels = components(links, scratch, "third")
    rooted = classes.select("node", "doc", "h1", "h2", "n").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    verdict = scratch.save(rooted.join(least, "root").select("h1", "h2", "n", "component"), "verdict")
    scratch.drop("entries", "sizes", "pairs", "sets", "left", "more", "parts", "classes", "firsts")
    members = rows.select("doc", "mark", "h1", "h2", "n").join(verdict, ["h1", "h2", "n"], "left")
    return members.select("doc", "mark", "n", F.coalesce("component", "doc").alias("component"))


def cluster(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest key reachable over links) and kept (its key is that).

    ``key`` is an integer. A null key comes after all others: component_id is null only where all of the group have none,
    and these are kept, as nothing tells which of them to keep. Each row is judged by its own text, also where its key is
    repeated. Documents without words have an empty set and no links; other columns are not read.
    """
    own = lambda c: F.when(F.col(c) < LAST, F.col(c))
    return clustered(docs, key, text).select(own("doc").alias(key), F.col("n").alias("n_shingles"), own("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``cluster`` does not keep; all columns stay, and rows without words."""
    gone = clustered(docs, key, text).filter("doc != component").select(F.col("doc").alias("_gone_doc"), F.col("mark").alias("_gone_mark")).distinct()
    return docs.join(gone, (key_of(key) == F.col("_gone_doc")) & (mark_of(key, text) == F.col("_gone_mark")), "left_anti")

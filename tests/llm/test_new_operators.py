"""Clusters, fingerprints and conversation repair against brute-force versions, and on awkward tables."""

import hashlib
import random
import re
import zlib
from math import inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from growth_spark.llm import bit_clusters, conversation_repair, queries, scaled_sketch

SF = "/root/testdata/sf0.001"


# --- clusters -----------------------------------------------------------------------------------------------------------


def plain_clusters(rows, k=40, rounds=5):
    """{vec_id: (cluster, distance, digest of the centroid)} with Python's integers."""
    from fractions import Fraction
    from math import floor

    kept = [(i, [floor(Fraction(x) * 256) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    return {i: (nearest(v)[1], nearest(v)[0], hashlib.sha256(",".join(map(str, centroids[nearest(v)[1]])).encode()).hexdigest()) for i, v in kept}


def as_found(df):
    return {r["vec_id"]: (r["cluster"], r["distance"], r["centroid_sha256"]) for r in df.collect()}


def test_clusters_are_the_plain_ones(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = queries.op11_bit_clusters(spark, SF)
    want = plain_clusters([(r["vec_id"], [float(x) for x in r["embedding"]]) for r in df.collect()])
    assert as_found(found) == want
    rows = found.collect()
    assert {r["inertia"] for r in rows} == {sum(d for _, d, _ in want.values())}
    assert all(r["cluster_inertia"] == sum(d for c, d, _ in want.values() if c == r["cluster"]) for r in rows)


def test_clusters_of_awkward_tables(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-1.5, 0.0, 0.25, 3.999, -0.001]) for _ in range(64)]) for i in range(30)]
    vectors += [(100, None), (101, [1.0] * 63), (102, [1.0] * 65), (103, [None] + [1.0] * 63), (104, [nan] + [1.0] * 63), (105, [inf] + [1.0] * 63), (None, [0.5] * 64)]
    schema = "vec_id bigint, embedding array<double>"
    df = spark.createDataFrame(vectors, schema).withColumns({c: F.lit(1) for c in ("planes", "cluster", "distance", "x", "total", "_order")}).repartition(3)
    assert as_found(bit_clusters.cluster(df, k=7, rounds=3)) == plain_clusters(vectors, 7, 3)
    assert as_found(bit_clusters.cluster(df)) == plain_clusters(vectors)  # fewer vectors than centroids
    twice = bit_clusters.cluster(df.unionByName(df), k=7, rounds=3)  # repeated rows count
    assert twice.count() == 2 * bit_clusters.cluster(df, k=7, rounds=3).count()
    none = bit_clusters.cluster(df.limit(0))
    assert none.count() == 0 and none.columns == twice.columns


def test_components_of_any_size_are_exact(spark):
    rng = random.Random(6)
    vectors = [(i, [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.choice([0, 20, 30]) for _ in range(64)]) for i in range(12)]
    vectors += [(20, [3e38] * 64), (21, [-3e38] * 64), (22, [0.0] * 64)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    most = (1 << 63) - 1
    want = {i: (c, min(d, most), h) for i, (c, d, h) in plain_clusters(vectors, 4, 2).items()}
    assert as_found(bit_clusters.cluster(df, k=4, rounds=2)) == want


def test_planes_hold_the_components():
    rng = np.random.default_rng(1)
    for low, high in ((-5, 5), (0, 1), (-1, 0), (0, 1 << 20), (-(1 << 27), 1 << 27)):
        a, b = rng.integers(low, high + 1, (9, 64)), rng.integers(low, high + 1, (4, 64))
        x, y = bit_clusters.pack(a), bit_clusters.pack(b)
        assert (bit_clusters.products(x, y) == a @ b.T).all()
        assert (bit_clusters.squares(x) == (a * a).sum(1)).all()
        assert (bit_clusters.component_sums(x, np.array([0, 4])) == np.add.reduceat(a, [0, 4], axis=0)).all()


# --- fingerprints -------------------------------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def edited_texts(rows):
    """(key, text, edited, next text) in order."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, (key, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        yield key, text, text[: len(text) - half] + after[:half], after


def true_likeness(a, b):
    return 1.0 if a == b else len(a & b) / min(len(a), len(b)) if a and b else 0.0


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_fingerprints_estimate_what_sets_share(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in scaled_sketch.edited(docs, parts=parts).collect()}
    assert len(found) == len(rows)
    near, after = [], []
    for key, text, changed, next_text in edited_texts(rows):
        r, a = found[key], word_shingles(text)
        assert (r["n_chars"], r["edited_sha256"], r["n_shingles"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), len(a))
        assert r["fingerprint"] == scaled_sketch.Sketch.of(text.encode()).written() and r["edited_fingerprint"] == scaled_sketch.Sketch.of(changed.encode()).written()
        near.append(r["near_edited"] - true_likeness(a, word_shingles(changed)))
        after.append(r["near_next"] - true_likeness(a, word_shingles(next_text)))
    assert abs(np.mean(near)) < 0.02 and np.mean(np.abs(near)) < 0.08 and np.mean(np.abs(after)) < 0.01


def test_fingerprints_of_awkward_tables(spark):
    long_ = " ".join(f"w{i % 977} v{i % 1013}" for i in range(60_000))
    rows = [(3, "Same words HERE and there now"), (4, "same words here and there now"), (5, None), (6, ""), (7, "a"), (8, "\t\n "), (9, long_), (10, "😀é " * 9), (None, "no key")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("key", "bytes", "extra", "_part", "_doc", "_mark", "n_chars", "fingerprint", "_at")})
    texts = [(k, t or "") for k, t in rows]
    found = {r["doc_id"]: r for r in scaled_sketch.edited(df, parts=4).collect()}
    for key, text, changed, _ in edited_texts(texts):
        assert (found[key]["n_chars"], found[key]["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
    assert found[3]["near_next"] == 1.0 and found[3]["fingerprint"] == found[4]["fingerprint"]
    assert found[5]["near_next"] == 1.0 and found[6]["near_next"] == 0.0  # nothing is like nothing, not like a word
    plain = {r["doc_id"]: r["fingerprint"] for r in scaled_sketch.fingerprints(df).collect()}
    assert plain == {k: r["fingerprint"] for k, r in found.items()}
    repeated = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(2, "x y z")], "doc_id bigint, text string")
    assert sorted(r["near_next"] for r in scaled_sketch.edited(repeated, parts=3).collect()) == [0.0, 0.0, 1.0, 1.0, 1.0, 1.0]
    assert scaled_sketch.edited(df.limit(0)).count() == 0
    (alone,) = scaled_sketch.edited(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id bigint, text string")).collect()
    assert alone["near_next"] == 1.0


def test_sketches_of_unequal_texts_and_their_union():
    rng = random.Random(2)
    big = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    other = [f"x{rng.randrange(10**6)}" for _ in range(5_000)]
    of = lambda words: scaled_sketch.Sketch.of(" ".join(words).encode())
    part = big[3000:3400]
    assert scaled_sketch.contained(of(part), of(big)) == 1.0 and scaled_sketch.contained(of(big), of(part)) < 0.04
    assert scaled_sketch.likeness(of(part), of(big))[0] == 1.0 and scaled_sketch.likeness(of(other), of(big)) == (0.0, 0.0)
    # Merging is the union of what is kept; only the four shingles over the seam are missing.
    both, joined = scaled_sketch.merged(of(big), of(other)), of(big + other).kept
    assert set(both) <= set(joined) and len(joined) - len(both) <= 4
    assert abs(len(of(big).kept) / of(big).size - 0.25) < 0.02
    a = of(big)
    back = scaled_sketch.Sketch.read(a.written())
    assert back[:2] == a[:2] and (back.kept == a.kept).all()


# --- conversations ------------------------------------------------------------------------------------------------------


def cheapest(rows):
    """(cost, audit) of (initial, fault) rows: every path relaxed until nothing changes, audits as whole strings."""
    best, todo = {(0, 0): (0, "")}, [(0, 0)]
    before = {1: (0,), 2: (0, 1, 3), 3: (2,)}

    def put(key, value):
        if key not in best or value < best[key]:
            best[key] = value
            todo.append(key)

    while todo:
        i, s = todo.pop()
        cost, audit = best[i, s]
        for r in (2, 3):
            if s in before[r]:
                put((i, r), (cost + 5, audit + "I"))
        if i < len(rows):
            initial, fault = rows[i]
            put((i + 1, s), (cost + 2, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more, own = 5 * (fault == "truncated"), {"s": 1, "u": 2, "a": 3}.get(initial)
                if own and s in before[own]:
                    put((i + 1, own), (cost + more, audit + "K"))
                for r in (2, 3):
                    if s in before[r]:
                        put((i + 1, r), (cost + 1 + more, audit + "R"))
    return min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)


def plain_repair(rows):
    kept = {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if rule == 1:
            text = ""
        if rule == 2:
            text = re.sub("[.!?]", "", text)
        if rule == 4:
            role = "user"
        kept[conv] += [(turn, role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
    out = {}
    for conv, mine in kept.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, edits = [t for t, _, _ in mine if t is not None], set(), []
        for _, role, text in mine:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            edits.append((role[:1], "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        counts = [sum(f == name for _, f in edits) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(edits, edits[1:], strict=False))
        cost, audit = cheapest(edits)
        lines, at, user = [], 0, True
        for letter in audit:
            _, role, text = ("", "", "") if letter == "I" else mine[at]
            at += letter != "I"
            if letter != "D":
                lines.append(f"{role if letter == 'K' else 'user' if user else 'assistant'}:{text}")
                user = user if letter == "K" and role[0] == "s" else not user
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def same_repair(df, **bounds):
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(df, **bounds).collect()}
    assert found == plain_repair([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 2}, {"most_characters": 60}])
def test_conversations_are_repaired_at_least_cost(spark, bounds):
    same_repair(spark.read.parquet(f"{SF}/conversations.parquet"), **bounds)


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 5}])
def test_awkward_and_long_conversations(spark, bounds):
    """Null keys, turns, roles and texts, ties, repeated rows, one conversation of most rows, clashing columns."""
    rng = random.Random(3)
    texts = [None, "", "Hi.", "Yo", "  ", "a b! ", "w. \n", "long " * 400 + "."]
    rows = [(rng.choice([None, 1, 2, 3, 3, 3, 3, 3]), rng.choice([None, *range(90)]), rng.choice([None, "user", "assistant", "system", "", "x", "user", "assistant"]), rng.choice(texts)) for _ in range(900)]
    rows += [(3, 1, "user", "Hi.")] * 300 + [(9, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit(1) for c in ("n", "block", "audit", "cost", "alike", "again", "rule", "_conv", "_turn", "whole")})
    same_repair(df.repartition(5), **bounds)
    assert conversation_repair.repair(df.limit(0)).count() == 0


def test_audits_of_random_rows():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice("suaax "), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(13))]
        cost, edit = conversation_repair.ended(conversation_repair.solved(rows, conversation_repair.START))
        assert (cost, conversation_repair.letters(edit)) == cheapest(rows)


@pytest.mark.parametrize("modulus", [conversation_repair.MOD, 3, 1])
def test_common_prefixes_even_where_hashes_collide(monkeypatch, modulus):
    monkeypatch.setattr(conversation_repair, "MOD", modulus)
    rng = random.Random(4)

    def audit(letters, back=None):
        for x in letters:
            back = conversation_repair.Edit(x, back)
        return back

    for _ in range(400):
        shared = audit("".join(rng.choice("DK") for _ in range(rng.randrange(9))))
        x, y = ("".join(rng.choice("DK") for _ in range(rng.randrange(9))) for _ in range(2))
        a, b = audit(x, shared), audit(y, shared)
        one, two = conversation_repair.letters(a), conversation_repair.letters(b)
        n = next((i for i, (p, q) in enumerate(zip(one, two, strict=False)) if p != q), min(len(one), len(two)))
        if modulus == conversation_repair.MOD:
            assert conversation_repair.common(a, b) == n
        assert conversation_repair.less(a, b) == (one < two)

"""Centroid clustering of vectors of 64 integers by bit planes.

A vector's 64 components are kept as two's complement bit planes, each packed into one unsigned 64-bit word. The scalar
product with a centroid is the sum, over pairs of planes, of the planes' weights times the number of bits that both have
set, so products and squared distances are exact integers. Packed vectors are written once; every round reads them again,
assigns them in parallel and hands back one sum a centroid and component.

* Vectors with another number of components, or with a null or non-finite one, are left out. An empty table gives no row;
  fewer vectors than centroids give as many centroids as there are vectors.
* Each row counts, repeated ones too. A row without ``vec_id`` is kept and comes last in the order that picks the first
  centroids; rows of one ``vec_id`` follow in the order of their components. Other columns are not looked at.
* Components of any size are exact: beyond 28 planes the arithmetic goes over to Python's integers. A distance or sum
  of distances beyond a 64-bit integer is given as the greatest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

WIDTH, SCALE = 64, 256
K, ROUNDS, SEED = 40, 5, "2"
#: Planes up to which products of 64 components and their sums fit into 64 bits.
NARROW = 28
#: Vectors that are compared with all centroids at a time.
LOT = 1024
MOST = (1 << 63) - 1
#: Sums travel in parts of so many bits, so that sums of parts fit into 64 bits.
PART = 32


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == WIDTH) & finite, F.lit(False))


def scaled(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` as integers; as Python's where they don't fit into 64 bits."""
    with np.errstate(over="ignore"):
        made = np.floor(values * SCALE)
    if np.abs(made).max(initial=0) < 2.0**62:
        return made.astype(np.int64)
    exact = [int(x) * SCALE + int(np.floor((x - int(x)) * SCALE)) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def n_planes(rows: np.ndarray) -> int:
    """Planes that hold every component with its sign."""
    return max(max(int(rows.max()).bit_length(), int(~rows.min()).bit_length()), 1) + 1 if rows.size else 1


def pack(rows: np.ndarray) -> np.ndarray:
    """Planes by vectors, as uint64; bit c of plane b is bit b of component c."""
    planes = [((rows >> b) & 1).astype(np.uint8) for b in range(n_planes(rows))]
    return np.stack([np.packbits(p, axis=1, bitorder="little").view(np.uint64).reshape(-1) for p in planes])


def weights(n: int) -> list[int]:
    """Of ``n`` planes; the last one is the sign's."""
    return [1 << b for b in range(n - 1)] + [-(1 << (n - 1))]


def kind(*planes: int) -> type:
    return np.int64 if max(planes) <= NARROW else object


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scalar products of all vectors of ``a`` with all of ``b``, both planes by vectors."""
    number = kind(len(a), len(b))
    out = np.zeros((a.shape[1], b.shape[1]), number)
    for wa, x in zip(weights(len(a)), a, strict=True):
        row = np.zeros_like(out)
        for wb, y in zip(weights(len(b)), b, strict=True):
            row += np.bitwise_count(x[:, None] & y[None, :]).astype(number) * wb
        out += row * wa
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Scalar product of each vector with itself."""
    number, w = kind(len(a)), weights(len(a))
    out = np.zeros(a.shape[1], number)
    for i, x in enumerate(a):
        out += np.bitwise_count(x).astype(number) * (w[i] * w[i])
        for j in range(i):
            out += np.bitwise_count(x & a[j]).astype(number) * (2 * w[i] * w[j])
    return out


def component_sums(a: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the components over runs of vectors that begin at ``starts``."""
    number = kind(len(a))
    out = np.zeros((len(starts), WIDTH), number)
    for w, plane in zip(weights(len(a)), a, strict=True):
        bits = np.unpackbits(np.ascontiguousarray(plane).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += np.add.reduceat(bits, starts, axis=0, dtype=np.int64).astype(number) * w
    return out


class Centroids:
    """Centroids as integers, ready for comparison."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.rows = rows
        exact = np.array(rows, object).reshape(-1, WIDTH)
        self.planes = pack(exact)
        self.squares = squares(self.planes)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (of equal ones the smallest) and the squared distance to it."""
        far = squares(vectors)[:, None] - 2 * products(vectors, self.planes) + self.squares[None, :]
        best = far.argmin(axis=1)
        return best, far[np.arange(len(best)), best]

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in self.rows]


def packed(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, planes: one word each, lowest first) of the usable vectors."""
    rows = vectors.filter(usable(vector)).select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    id_type = dict(rows.dtypes)["vec_id"]

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            values = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            planes = pack(scaled(values))
            flat = np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)
            offsets = np.arange(len(values) + 1, dtype=np.int32) * len(planes)
            yield {"vec_id": batch["vec_id"], "planes": pa.ListArray.from_arrays(offsets, flat)}

    return map_batches(rows, body, f"vec_id {id_type}, planes array<bigint>")


def lots(batches: Iterator[dict]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, planes by vectors) of rows that have the same number of planes."""
    for batch in batches:
        sizes = batch["planes"].value_lengths().to_numpy(zero_copy_only=False)
        for n in np.unique(sizes):
            where = np.flatnonzero(sizes == n)
            for a in range(0, len(where), LOT):
                at = pa.array(where[a : a + LOT])
                flat = batch["planes"].take(at).flatten().to_numpy(zero_copy_only=False)
                yield batch["vec_id"].take(at), np.ascontiguousarray(flat.view(np.uint64).reshape(-1, n).T)


def first_centroids(rows: DataFrame, k: int, seed: str) -> Centroids | None:
    """The ``k`` vectors of smallest sha256 of ``seed:vec_id``; None without any vector."""
    order = F.coalesce(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256), F.lit("none"))
    found = rows.select("planes", order.alias("_order")).orderBy("_order", "planes").limit(k).collect()
    unpacked = []
    for row in found:
        words, w = [x & ((1 << 64) - 1) for x in row["planes"]], weights(len(row["planes"]))
        unpacked.append([sum(wb * ((p >> c) & 1) for wb, p in zip(w, words, strict=True)) for c in range(WIDTH)])
    return Centroids(unpacked) if unpacked else None


def sums(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """(cluster, component, part, total, n): sums over each centroid's vectors, in parts of ``PART`` bits; the number of
    vectors is at component -1."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros((len(centroids.rows), WIDTH), object)
        count = np.zeros(len(centroids.rows), np.int64)
        for _, planes in lots(batches):
            best, _ = centroids.nearest(planes)
            order = np.argsort(best, kind="stable")
            present, starts, n = np.unique(best[order], return_index=True, return_counts=True)
            total[present] += component_sums(planes[:, order], starts)
            count[present] += n
        out = {name: [] for name in ("cluster", "component", "part", "total")}

        def put(*row: int) -> None:
            for values, x in zip(out.values(), row, strict=True):
                values.append(x)

        for c in np.flatnonzero(count).tolist():
            put(c, -1, 0, int(count[c]))
            for i, x in enumerate(total[c]):
                rest, part = int(x), 0
                while True:  # the last part carries the sign
                    whole = -(1 << PART) <= rest < (1 << PART)
                    put(c, i, part, rest if whole else rest & ((1 << PART) - 1))
                    if whole:
                        break
                    rest, part = rest >> PART, part + 1
        if out["cluster"]:
            yield out

    made = map_batches(rows, body, "cluster int, component int, part int, total bigint")
    return made.groupBy("cluster", "component", "part").agg(F.sum("total").alias("total"))


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays. At most some thousand sums come
    to the driver, whatever the number of vectors."""
    found: dict[tuple[int, int], int] = {}
    for r in sums(rows, centroids).collect():
        at = (r["cluster"], r["component"])
        found[at] = found.get(at, 0) + (r["total"] << (PART * r["part"]))
    new = [[found.get((c, i), 0) // found[c, -1] for i in range(WIDTH)] if (c, -1) in found else old for c, old in enumerate(centroids.rows)]
    return Centroids(new)


def assigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """(vec_id, cluster, distance)."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for ids, planes in lots(batches):
            best, far = centroids.nearest(planes)
            yield {"vec_id": ids, "cluster": best.astype(np.int32), "distance": np.minimum(far, MOST).astype(np.int64)}

    return map_batches(rows, body, f"vec_id {dict(rows.dtypes)['vec_id']}, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, and the centroid
    itself (its components as decimal strings, since they may pass 64 bits)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "bit-clusters")
    rows = scratch.save(packed(vectors, vec_id, vector), "packed")
    centroids = first_centroids(rows, k, seed)
    made = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<string>"
    totals: list[tuple] = []
    if centroids is not None:
        for _ in range(rounds):
            centroids = moved(rows, centroids)
        found = scratch.save(assigned(rows, centroids), "assigned")
        scratch.drop("packed")
        each = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
        digests, inertia = centroids.digests(), min(sum(each.values()), MOST)
        totals = [(c, min(x, MOST), inertia, digests[c], list(map(str, centroids.rows[c]))) for c, x in sorted(each.items())]
    else:
        found = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    # One row a centroid.
    return found.join(F.broadcast(spark.createDataFrame(totals, made)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")

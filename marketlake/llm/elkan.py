"""Centroid clustering of integer vectors with Elkan's bounds; every distance that decides is an exact integer.

Vectors lie in blocks, a row a block: ids, integers, and what is remembered of each vector: its cluster, an upper bound of the
distance to that centroid and a lower bound of the distance to each. A round moves the bounds by how far the centroids went,
then looks only at vectors and centroids that the bounds and the distances between centroids leave open. Bounds are doubles,
rounded away from what they bound, and a centroid is passed over only if it is surely farther, not if it may be as far: ties go
to the smaller number as if all distances had been computed.

Each round is one narrow pass that writes the blocks anew; tasks then add the vectors of each cluster and Spark adds the tasks'
sums in limbs of 32 bits, exact at any size. The driver holds k centroids. The round before is deleted once the next is written.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import release, written

#: Vectors of a block.
BLOCK = 4096
#: Limbs of a sum: 32 bits each but the last, which holds the sign.
LIMBS = 7
#: A bound is moved by this share of itself, more than the rounding of a root, a sum or a difference of doubles.
SLACK = 2.0**-48


def small(size: int) -> int:
    """Integers below this have squared distances of `size` components within 64 bits; larger ones are whole numbers of Python."""
    return math.isqrt(((1 << 63) - 1) // max(size, 1)) // 2


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(1024 x) of doubles, as int64, or as whole numbers of Python where one is large."""
    y = np.floor(1024.0 * x)
    if not y.size or np.abs(y).max() < small(x.shape[1]):
        return y.astype(np.int64)
    return np.array([[math.floor(v) if math.isfinite(v) else int(w) * 1024 for v, w in zip(a, b, strict=True)] for a, b in zip(y.tolist(), x.tolist(), strict=True)], object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to a centroid."""
    d = x - c
    return (d * d).sum(axis=1) if len(d) else np.zeros(0, d.dtype)


def _root(d: np.ndarray, most: float) -> np.ndarray:
    if d.dtype == object:
        return np.array([float(r) if (r := math.isqrt(v)) < 10**300 else most for v in d], np.float64)
    return np.sqrt(d.astype(np.float64))


def above(d: np.ndarray) -> np.ndarray:
    """Doubles not below the roots of exact integers."""
    return (_root(d, np.inf) + (d.dtype == object)) * (1 + SLACK)


def below(d: np.ndarray) -> np.ndarray:
    """Doubles not above the roots of exact integers."""
    return _root(d, 1e300) * (1 - SLACK)


class Centroids:
    """k centroids of exact integers, with half the distances between them and how far each came since the round before."""

    def __init__(self, values: list[list[int]], before: list[list[int]] | None = None):
        self.values = values
        size = len(values[0]) if values else 0
        kind = object if any(abs(v) >= small(size) for c in values + (before or []) for v in c) else np.int64
        c = np.array(values, kind).reshape(len(values), size)
        self.rows = c
        self.half = np.array([below(squared(c, x)) / 2 * (1 - SLACK) for x in c]).reshape(len(c), len(c))
        self.moved = above(((c - np.array(before, kind)) ** 2).sum(axis=1)) if before is not None else np.zeros(len(c))
        apart = self.half.copy()
        np.fill_diagonal(apart, np.inf)
        self.near = apart.min(axis=1) if len(c) else np.zeros(0)


def assign(x: np.ndarray, c: Centroids, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Gives each row its nearest centroid (the smaller number of equally near ones) and sets its bounds; the number of distances computed.

    `cluster`, `upper` and `lower` are those of the round before and are changed in place. Upper bounds of infinity start anew.
    """
    if x.dtype == object and c.rows.dtype != object:
        rows = c.rows.astype(object)
    else:
        rows, x = c.rows, x.astype(object) if c.rows.dtype == object else x
    upper += c.moved[cluster]
    upper *= 1 + SLACK
    lower -= c.moved
    np.maximum(lower * (1 - SLACK), 0, out=lower)
    open_ = np.flatnonzero(upper >= c.near[cluster])
    exact = np.empty(len(open_), x.dtype)  # of the open rows
    computed = 0
    for a in range(len(rows)):
        here = np.flatnonzero(cluster[open_] == a)
        exact[here] = squared(x[open_[here]], rows[a])
        computed += len(here)
    upper[open_] = above(exact)
    for j in range(len(rows)):
        u, a = upper[open_], cluster[open_]
        look = np.flatnonzero((a != j) & (u >= lower[open_, j]) & (u >= c.half[a, j]))
        if not len(look):
            continue
        at = open_[look]
        d = squared(x[at], rows[j])
        computed += len(at)
        lower[at, j] = below(d)
        closer = (d < exact[look]) | ((d == exact[look]) & (j < cluster[at]))
        closer = closer.astype(bool)
        went, here = at[closer], look[closer]
        lower[went, cluster[went]] = below(exact[here])
        cluster[went], exact[here] = j, d[closer]
        upper[went] = above(d[closer])
    return computed


def sums(x: np.ndarray, cluster: np.ndarray, k: int) -> tuple[list[int], list[list[int]]]:
    """Counts and componentwise sums of each cluster, exact: int64 holds the sums of a block of small integers."""
    got = [x[cluster == j] for j in range(k)]
    return [len(g) for g in got], [[int(v) for v in g.sum(axis=0)] if len(g) else [0] * x.shape[1] for g in got]


def limbs(n: int) -> list[int]:
    return [(n >> 32 * i) & 0xFFFFFFFF for i in range(LIMBS - 1)] + [n >> 32 * (LIMBS - 1)]


def whole(parts: list[int]) -> int:
    return sum(p << 32 * i for i, p in enumerate(parts))


STATE = "ids array<{id}>, x binary, big array<string>, cluster binary, upper binary, lower binary, n long, computed long"


def usable(embedding: Column, size: int) -> Column:
    """Vectors of this many components, none of them null or not finite."""
    fine = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(embedding) == size) & fine, F.lit(False))


def _pack(x: np.ndarray) -> tuple[bytes, list[str] | None]:
    """Integers in two, four or eight bytes, or as text where they are larger."""
    if x.dtype == object:
        return b"", [str(v) for v in x.ravel()]
    top = int(np.abs(x).max()) if x.size else 0
    return bytes([w := 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8]) + x.astype(f"<i{w}").tobytes(), None


def _unpack(raw: bytes, big: list[str] | None, size: int) -> np.ndarray:
    if big is not None:
        return np.array([int(v) for v in big], object).reshape(-1, size)
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64).reshape(-1, size)


def first_centroids(vectors: DataFrame, k: int, size: int) -> list[list[int]]:
    """The k vectors of smallest sha256 of `3:<id>` (equal hashes by components, a null id last)."""
    at = F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")), 256)
    rows = vectors.withColumn("h", at).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()  # k rows
    return [[int(v) for v in scaled(np.array(r["x"], np.float64).reshape(1, size))[0]] for r in rows]


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> tuple[DataFrame, list[list[int]]]:
    """Blocks of vectors with their clusters after the last assignment, and the centroids that they were assigned to.

    Vectors that are null, of another size, or hold null or not finite components are left out. Repeated rows count each for
    itself. Fewer vectors than k start fewer clusters; an empty table gives no blocks and no centroids.
    """
    own = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("x")).where(usable(F.col("x"), size))
    start = first_centroids(own, k, size)
    k = len(start)
    kind = own.schema["id"].dataType.simpleString()
    schema = STATE.replace("{id}", kind)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), block):
                part = b.slice(at, block)
                raw, big = _pack(scaled(pc.list_flatten(part.column("x")).to_numpy(zero_copy_only=False).reshape(-1, size)))
                n = len(part)
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("id"))
                yield _state(ids, raw, big, np.zeros(n, np.int32), np.full(n, np.inf), np.zeros((n, k)), n, 0)

    blocks = written(own.mapInArrow(first, schema), "vectors")
    centroids = Centroids(start)
    for r in range(rounds + 1):
        step = written(_round(blocks, centroids, size, schema), "assigned")
        release(blocks)
        blocks = step
        if r < rounds and k:
            new = _means(blocks, centroids, size)
            centroids = Centroids(new, centroids.values)
    return blocks, centroids.values


def _state(ids: pa.Array, raw: bytes, big: list[str] | None, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, n: int, computed: int) -> pa.RecordBatch:
    binary = lambda v: pa.array([v], pa.binary())
    cols = [ids, binary(raw), pa.array([big], pa.list_(pa.string())), binary(cluster.astype("<i4").tobytes()), binary(upper.astype("<f8").tobytes()), binary(lower.astype("<f8").tobytes()), pa.array([n], pa.int64()), pa.array([computed], pa.int64())]
    return pa.RecordBatch.from_arrays(cols, ["ids", "x", "big", "cluster", "upper", "lower", "n", "computed"])


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(len(b)):
            yield b.slice(i, 1), _unpack(b.column("x")[i].as_py(), b.column("big")[i].as_py(), size)


def _round(blocks: DataFrame, centroids: Centroids, size: int, schema: str) -> DataFrame:
    """The blocks with their vectors assigned to these centroids."""
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)  # k vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b, x in _blocks(batches, size):
            of, upper, lower = (np.frombuffer(b.column(name)[0].as_py(), t).copy() for name, t in (("cluster", "<i4"), ("upper", "<f8"), ("lower", "<f8")))
            lower = lower.reshape(len(x), len(c.rows))
            computed = assign(x, c, of, upper, lower)
            yield _state(pa.concat_arrays([b.column("ids")]), b.column("x")[0].as_py(), b.column("big")[0].as_py(), of, upper, lower, len(x), computed)

    return blocks.mapInArrow(run, schema)


def _means(blocks: DataFrame, centroids: Centroids, size: int) -> list[list[int]]:
    """floor(sum / count) of each cluster, componentwise; an empty cluster keeps its centroid."""
    k = len(centroids.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = [0] * k, np.zeros((k, size), object)
        for b, x in _blocks(batches, size):
            n, s = sums(x, np.frombuffer(b.column("cluster")[0].as_py(), "<i4"), k)
            counts = [u + v for u, v in zip(counts, n, strict=True)]
            total = total + np.array(s, object)
        rows = [(j, i, limbs(int(total[j, i])) if i < size else limbs(counts[j])) for j in range(k) for i in range(size + 1) if counts[j]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["j", "i", "v"])

    parts = blocks.select("x", "big", "cluster").mapInArrow(run, "j int, i int, v array<long>")
    got = parts.groupBy("j", "i").agg(*(F.sum(F.get("v", F.lit(p))).alias(f"v{p}") for p in range(LIMBS))).collect()  # k * (size + 1) rows
    value = {(r["j"], r["i"]): whole([r[f"v{p}"] for p in range(LIMBS)]) for r in got}
    return [[value[j, i] // value[j, size] for i in range(size)] if (j, size) in value else old for j, old in enumerate(centroids.values)]


def report(df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that is kept; see `cluster`.

    A distance or a sum of 2^63 or more has no long value and is null.
    """
    blocks, values = cluster(df, k, rounds, size)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Centroids(values))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value.rows
        for b, x in _blocks(batches, size):
            of = np.frombuffer(b.column("cluster")[0].as_py(), "<i4")
            d = np.empty(len(x), object)
            for j, c in enumerate(rows):
                d[of == j] = squared(x[of == j], c)
            yield pa.RecordBatch.from_arrays([b.column("ids").flatten(), pa.array(of.astype(np.int32)), pa.array([int(v) if v < 1 << 63 else None for v in d], pa.int64())], ["vec_id", "cluster", "distance"])

    found = blocks.select("ids", "x", "big", "cluster").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    one = found.groupBy("cluster").agg(F.when(F.count_if(F.col("distance").isNull()) == 0, exact).alias("c"))
    per = {r["cluster"]: r["c"] for r in one.collect()}  # k rows
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    total = None if any(v is None for v in per.values()) else sum(map(int, per.values()))
    rows = [(j, fits(None if per.get(j) is None else int(per[j])), fits(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(values)]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows

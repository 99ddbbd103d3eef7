"""Centroid clustering of integer vectors (Lloyd's rounds), exact.

A vector's components become integers floor(scale * x). Squared distances come from |x|^2 - 2 x.c + |c|^2 with one float64 matrix product for
a block of vectors and all centroids. All numbers in it are integers; where a bound on the magnitudes says that each of them, and each
partial sum, is under 2**53, doubles hold them exactly in whatever order BLAS adds. Other blocks are computed with integers of any size.

Vectors are packed once, a row for a batch of them, into a table in the shared folder; each round is one pass over it. A task adds up its
vectors by cluster, treeAggregate combines sums and counts, and the driver holds k of these only. Vectors are never shuffled, so a
cluster or a vector that has a third of all rows costs nothing extra.

Kept are vectors with exactly `dims` components, none null, NaN or infinite (nor infinite when scaled, in doubles); the others are left out. Rounds start from the k kept vectors of
the smallest hashes of vec_id; ids that are there twice are told apart by their components' bytes, and rows without vec_id come last. With
fewer than k vectors each is a centroid. Ties go to the smaller cluster number; empty clusters stay where they are. Sums of distances or distances
beyond 64 bits are null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import cut

SCHEMA = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
PACKED = "ids binary, known binary, wide boolean, vectors binary"
#: Rows of a matrix product.
BLOCK = 4096


@dataclass(frozen=True)
class Params:
    """k: clusters. dims: components of a vector. scale: of the integers. rounds: of assigning and moving. seed: of the start."""

    k: int = 40
    dims: int = 64
    scale: int = 256
    rounds: int = 5
    seed: int = 2


def packed(embeddings: DataFrame, p: Params) -> DataFrame:
    """A row for each Arrow batch of embeddings(vec_id, embedding): ids, a byte for each that isn't null, vectors (as floats or doubles, row by
    row) of those kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(vectors), p.dims), False))
            values = batch.column(1).flatten()
            wide = not pa.types.is_float32(values.type)
            x = (values.cast(pa.float64()) if wide else values).to_numpy(zero_copy_only=False).reshape(-1, p.dims)  # a null is a NaN here
            good = np.isfinite(p.scale * x.astype(np.float64)).all(1)
            if good.any():
                ids = batch.column(0).filter(pa.array(good))
                known = np.asarray(ids.is_valid()).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()), pa.array([known.tobytes()], pa.binary()), pa.array([wide]), pa.array([x[good].tobytes()], pa.binary())], names=["ids", "known", "wide", "vectors"])

    return embeddings.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(run, PACKED)


def integers(wide: bool, vectors: bytes, p: Params) -> np.ndarray:
    """The vectors of a packed row as whole numbers in doubles, [n, dims]. A double holds floor(scale * x) of any float exactly; of a double x
    the product is rounded once, as the definition has it."""
    x = np.frombuffer(vectors, np.float64 if wide else np.float32).reshape(-1, p.dims)
    return np.floor(p.scale * x.astype(np.float64))


def exact_in_doubles(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The rows of x for which all terms and sums of |x|^2 - 2 x.c + |c|^2 are under 2**53."""
    top = np.maximum(np.abs(x).max(1), max((abs(int(v)) for v in c.flat), default=0))
    return top < np.sqrt(2.0**53 / (4 * x.shape[1])) - 1


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x (whole numbers in doubles) the number of the nearest centroid (rows of c, integers of any size as objects; ties: the
    smaller), and the squared distance (integers as objects if any is beyond 64 bits)."""
    n = len(x)
    cluster, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    safe = exact_in_doubles(x, c)
    if safe.any():
        f = c.astype(np.float64)
        norms = (f * f).sum(1)
        at = np.flatnonzero(safe)
        for i in range(0, len(at), BLOCK):
            rows = x[at[i : i + BLOCK]]
            d = (rows * rows).sum(1)[:, None] - 2 * (rows @ f.T) + norms
            cluster[at[i : i + BLOCK]] = best = d.argmin(1)
            distance[at[i : i + BLOCK]] = d[np.arange(len(best)), best].astype(np.int64)
    for i in np.flatnonzero(~safe).tolist():
        row = np.array([int(v) for v in x[i].tolist()], object)
        d = ((c - row) ** 2).sum(1).tolist()
        cluster[i] = d.index(min(d))
        if min(d) >= 1 << 63 and distance.dtype != object:
            distance = distance.astype(object)
        distance[i] = min(d)
    return cluster, distance


def sums(x: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and componentwise sums by cluster, the latter as integers of any size."""
    out = np.zeros((k, x.shape[1]), object)
    for i in range(0, len(x), BLOCK):
        rows, mine = x[i : i + BLOCK], cluster[i : i + BLOCK]
        if np.abs(rows).max(initial=0) * BLOCK < 2.0**53:
            out += ((mine[:, None] == np.arange(k)).astype(np.float64).T @ rows).astype(np.int64).astype(object)
        else:
            for j, row in zip(mine.tolist(), rows.tolist()):
                out[j] += np.array([int(v) for v in row], object)
    return np.bincount(cluster, minlength=k), out


def start(blocks: DataFrame, p: Params) -> np.ndarray:
    """The first centroids; at most k rows leave a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[str, bytes]] = []
        for batch in batches:
            for ids, known, wide, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                x, marks = integers(wide, vectors, p), bytes(known)
                hashes = (hashlib.sha256(f"{p.seed}:{v}".encode()).hexdigest() if marks[i] else "null" for i, v in enumerate(np.frombuffer(ids, np.int64).tolist()))
                least = heapq.nsmallest(p.k, chain(least, ((h, x[i].tobytes()) for i, h in enumerate(hashes))))  # "null" comes after all digits
        if least:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in least]), pa.array([v for _, v in least], pa.binary())], names=["hash", "vector"])

    rows = blocks.mapInArrow(run, "hash string, vector binary").orderBy("hash", "vector").limit(p.k).collect()
    return np.array([[int(v) for v in np.frombuffer(r["vector"], np.float64).tolist()] for r in rows], object).reshape(len(rows), p.dims)


def aggregate(blocks: DataFrame, centroids: np.ndarray, p: Params, moving: bool) -> list[np.ndarray]:
    """By cluster: counts and sums of the vectors nearest to it (moving), or sums of their squared distances."""
    sc = blocks.sparkSession.sparkContext
    held, k = sc.broadcast(centroids), len(centroids)

    def add(acc: list | None, row) -> list:
        x = integers(row["wide"], bytes(row["vectors"]), p)
        cluster, distance = nearest(x, held.value)
        if moving:
            return both(acc, list(sums(x, cluster, k)))
        total = np.zeros(k, object)
        for j in range(k):
            total[j] = sum(distance[cluster == j].tolist())
        return both(acc, [total])

    def both(a: list | None, b: list | None) -> list | None:
        return b if a is None else a if b is None else [x + y for x, y in zip(a, b)]

    out = blocks.rdd.treeAggregate(None, add, both, 3)
    held.destroy()
    return out


def fit(blocks: DataFrame, p: Params) -> tuple[np.ndarray, list[int]]:
    """The centroids after all rounds, and the sum of squared distances of each cluster."""
    c = start(blocks, p)
    if not len(c):
        return c, []
    for _ in range(p.rounds):
        n, s = aggregate(blocks, c, p, True)
        c = np.array([[v // m for v in row] if m else old for row, m, old in zip(s.tolist(), n.tolist(), c.tolist())], object)
    return c, aggregate(blocks, c, p, False)[0].tolist()


def long(v: int) -> int | None:
    return v if v < 1 << 63 else None


def assigned(blocks: DataFrame, centroids: np.ndarray, inertia: list[int], p: Params) -> DataFrame:
    """A row for each vector."""
    held: Broadcast = blocks.sparkSession.sparkContext.broadcast(centroids)
    names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    each, total = pa.array([long(x) for x in inertia], pa.int64()), long(sum(inertia))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, wide, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                cluster, distance = nearest(integers(wide, vectors, p), held.value)
                at = pa.array(cluster)
                cols = [
                    pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(known, np.uint8) == 0),
                    at.cast(pa.int32()),
                    pa.array([long(v) for v in distance.tolist()], pa.int64()),
                    each.take(at),
                    pa.array([total] * len(at), pa.int64()),
                    pa.array(names).take(at),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split(" ")[0] for x in SCHEMA.split(", ")])

    return blocks.mapInArrow(run, SCHEMA)


def cluster(embeddings: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each kept vector of embeddings(vec_id, embedding): vec_id, cluster, distance (squared, to its centroid), cluster_inertia and
    inertia (sums of distances over its cluster and over all), centroid_sha256 (of its centroid's components, in decimal, comma-joined)."""
    blocks = cut(packed(embeddings, p))
    return assigned(blocks, *fit(blocks, p), p)

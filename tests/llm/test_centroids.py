"""Centroid clustering against a plain version in integers of any size."""

import hashlib
import math

import numpy as np
import pytest

from corvane.llm import centroids
from corvane.llm.centroids import Params

SMALL = Params(k=4, dims=3, rounds=3)


def plain(rows, p):
    kept = [(i, [math.floor(p.scale * x) for x in v]) for i, v in rows if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: ("null" if r[0] is None else hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), np.array(r[1], np.float64).tobytes())
    c = [v for _, v in sorted(kept, key=key)[: p.k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(p.rounds):
        at = assign()
        for k in range(len(c)):
            mine = [v for (_, v), (j, _) in zip(kept, at) if j == k]
            if mine:
                c[k] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    fits = lambda x: x if x < 1 << 63 else None
    inertia = [sum(d for j, d in at if j == k) for k in range(len(c))]
    out = [(i, j, fits(d), fits(inertia[j]), fits(sum(inertia)), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), (j, d) in zip(kept, at)]
    return sorted(out, key=repr)


def run(spark, rows, p, kind="float"):
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, distance double").repartition(3)
    return sorted((tuple(r) for r in centroids.cluster(df, p).collect()), key=repr)


def vectors(n, dims, spread=1.0, seed=0):
    x = (np.random.default_rng(seed).standard_normal((n, dims)) * spread).astype(np.float32)
    return [(i, x[i].tolist()) for i in range(n)]


ODD = [(100, None), (101, [1.0, 2.0]), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0]), (None, [0.5, 0.5, 0.5]), (7, [0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0])]


@pytest.mark.parametrize("spread", [1.0, 1e6, 1e12, 1e25])
def test_as_defined_at_any_magnitude(spark, spread):
    rows = vectors(60, 3, spread) + ODD + [(200 + i, [0.25, -0.25, 0.0]) for i in range(40)]
    assert run(spark, rows, SMALL) == plain(rows, SMALL)


def test_magnitudes_that_mix(spark):
    rows = vectors(40, 3) + [(100 + i, [1e18 * (i - 2), 3.0, 1e9]) for i in range(5)]
    assert run(spark, rows, SMALL, "double") == plain(rows, SMALL)


def test_fewer_vectors_than_clusters_and_ties(spark):
    rows = [(1, [0.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0])]
    assert run(spark, rows, SMALL) == plain(rows, SMALL)
    assert run(spark, [], SMALL) == [] and run(spark, ODD[:5], SMALL) == []


def test_no_ids(spark):
    rows = [(None, v) for _, v in vectors(20, 3)]
    assert run(spark, rows, SMALL) == plain(rows, SMALL)


def test_default_parameters(spark):
    rows = vectors(300, 64)
    assert run(spark, rows, Params()) == plain(rows, Params())


def test_bound_is_safe():
    """Just under the bound the product is exact, in the worst case of signs."""
    m = math.floor(math.sqrt(2.0**53 / (4 * 64)) - 1) - 1
    x = np.array([[m] * 64, [m, -m] * 32], np.float64)
    c = np.array([[-m] * 64, [m] * 64], object)
    assert centroids.exact_in_doubles(x, c).all() and not centroids.exact_in_doubles(x * 2, c).any()
    cluster, distance = centroids.nearest(x, c)
    assert cluster.tolist() == [1, 0] and distance.tolist() == [0, 32 * (2 * m) ** 2]

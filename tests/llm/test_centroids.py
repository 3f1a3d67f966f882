"""Centroid clustering against Lloyd's rounds in plain integers."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from rulewright.llm import centroids


def plainly(rows, k=40, rounds=5, dims=64, scale=256, seed=2):
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    at = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(at))
    for _ in range(rounds):
        own = [[] for _ in at]
        for _, v in kept:
            own[near(v)[1]].append(v)
        at = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, at, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha256(",".join(map(str, at[c])).encode()).hexdigest()) for i, c, d in found]


@pytest.fixture
def vectors(spark):
    def make(rows, kind="float"):
        return spark.createDataFrame([(*r, "v", 1, "c", 5) for r in rows], f"vec_id long, embedding array<{kind}>, vector string, weight long, cluster string, label int")

    return make


def check(got, rows, **more):
    out = [tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in got.collect()]
    assert sorted(out, key=str) == sorted(plainly(rows, **more), key=str)


def f32(values):
    return [float(np.float32(x)) for x in values]


def test_a_vector_that_half_of_all_rows_have(vectors):
    chance = random.Random(7)
    make = lambda: f32(chance.gauss(0, 0.2) for _ in range(64))
    common = make()
    rows = [(k, common if k % 2 else make()) for k in range(400)]
    check(centroids.cluster(vectors(rows).repartition(5)), rows)


def test_what_is_not_kept(vectors):
    rows = [(1, None), (2, []), (3, [0.5] * 3), (4, [0.25, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [-0.001, 0.5]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [2.0, 1.0]), (None, [3.0, -1.0])]
    check(centroids.cluster(vectors(rows), k=3, dimensions=2), rows, k=3, dims=2)


def test_ties_and_fewer_vectors_than_centroids(vectors):
    rows = [(k, [float(k % 3), 0.0]) for k in range(12)]
    check(centroids.cluster(vectors(rows), k=40, dimensions=2), rows, k=40, dims=2)
    check(centroids.cluster(vectors(rows), k=2, rounds=1, dimensions=2, scale=1), rows, k=2, rounds=1, dims=2, scale=1)


def test_large_components_stay_exact_and_larger_ones_fail(vectors):
    chance = random.Random(2)
    rows = [(k, [chance.uniform(-5e4, 5e4) for _ in range(64)]) for k in range(60)]
    check(centroids.cluster(vectors(rows, "double"), k=5), rows, k=5)
    with pytest.raises(Exception, match="would not fit in a long"):
        centroids.cluster(vectors([(1, [1e12, 0.0])], "double"), k=1, dimensions=2).collect()


def test_empty_table(vectors):
    assert centroids.cluster(vectors([(1, [1.0])]).limit(0)).count() == 0
    assert centroids.cluster(vectors([(1, [1.0])])).count() == 0


def test_nearest_is_the_same_in_doubles_and_integers():
    chance = np.random.default_rng(1)
    vectors, at = chance.integers(-50, 50, (200, 8)), chance.integers(-50, 50, (9, 8))
    by_hand = ((vectors[:, None] - at[None]) ** 2).sum(2)
    cluster, distance = centroids.nearest(vectors, at)
    assert (cluster == by_hand.argmin(1)).all() and (distance == by_hand.min(1)).all()
    big = 1 << 22
    cluster, distance = centroids.nearest(vectors * big, at * big)
    assert (cluster == by_hand.argmin(1)).all() and (distance == by_hand.min(1) * big * big).all()

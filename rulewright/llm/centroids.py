"""Centroid clustering of vectors, each distinct one worked on once.

Vectors are turned into integers, equal ones become one row with a count, and
Lloyd's rounds run over those rows: tasks assign them to the nearest centroid
and add them up, weighted by their counts, Spark adds what the tasks give, and
the driver keeps the few centroids.  At the end the assignments are joined back
to the ids.  All sums are of integers, so results don't depend on how rows are
dealt.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Components beyond this would make squared distances that a long can't hold.
LARGEST = 1 << 27
#: Vectors that more than one row in so many has are joined apart; there can't be more of them than this.
HOT = 200


def whole(vector: Column, dimensions: int) -> Column:
    """Whether a vector has exactly that many components, none null or non-finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as a double; an error beyond `LARGEST`."""
    fits = lambda q: F.when(F.abs(q) <= LARGEST, q).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST}: squared distances would not fit in a long")).cast("long"))
    return F.transform(vector, lambda x: fits(F.floor(x.cast("double") * scale)).cast("int"))


# -- in tasks --------------------------------------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, the smaller of equally near ones; its squared distance), in exact integers."""
    bound = vectors.shape[1] * max(1, int(np.abs(vectors).max(initial=0))) * max(1, int(np.abs(centroids).max(initial=0)))
    exact = bound < 1 << 52  # doubles then hold every partial sum of a product, and their matrix product is the faster
    kind = np.float64 if exact else np.int64
    crossed = (vectors.astype(kind) @ centroids.T.astype(kind)).astype(np.int64)
    apart = (vectors**2).sum(1)[:, None] - 2 * crossed + (centroids**2).sum(1)[None, :]
    cluster = apart.argmin(1)
    return cluster, apart[np.arange(len(vectors)), cluster]


def _sums(centroids: np.ndarray):
    def run(batches):
        k, dimensions = centroids.shape
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in common.merged(batches):
            vectors, weights = _matrix(batch, dimensions), batch.column("weight").to_numpy(zero_copy_only=False)
            cluster, _ = nearest(vectors, centroids)
            order = np.argsort(cluster, kind="stable")
            found, begin = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat((vectors * weights[:, None])[order], begin, axis=0)
            counts[found] += np.add.reduceat(weights[order], begin)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(own, pa.int32()), "n": pa.array(counts[own]), "sums": pa.array([*sums[own]], pa.list_(pa.int64()))})

    return common.tidily(run)


def _assigned(centroids: np.ndarray):
    def run(batches):
        for batch in common.merged(batches):
            cluster, distance = nearest(_matrix(batch, centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vector"), batch.column("weight"), pa.array(cluster, pa.int32()), pa.array(distance)], ["vector", "weight", "cluster", "distance"])

    return common.tidily(run)


# -- over all vectors ------------------------------------------------------------------------------------------


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The `k` vectors whose ids have the smallest sha256 of ``seed:id``; equal ids by their components, null ids last."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(named.asc_nulls_last(), F.col("embedding")).limit(k)
    return np.array([r["vector"] for r in first.select(quantised(F.col("embedding"), scale).alias("vector")).collect()], np.int64)


def moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means of their vectors, counts weighing; empty ones stay."""
    own = distinct.select("vector", "weight").mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    total = own.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(centroids.shape[1])]).alias("sums"))
    out = centroids.copy()
    for r in total.collect():  # a row a centroid
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) of `vectors` (vec_id, embedding).

    Only vectors with exactly `dimensions` components, none null or non-finite,
    are kept; repeated rows and ids each get a row and weigh as many.  A null
    id takes part and comes after all others for the first centroids; if fewer
    than `k` vectors are kept there are as many centroids.  Of equally near
    centroids the smaller number counts, so of equal ones the later stay empty.
    A component beyond 2^27 after quantising raises an error, as its squared
    distance would not fit in a long; so do sums of distances that don't.  No kept vectors give no rows; other
    columns are left behind.
    """
    common.small_batches(vectors.sparkSession)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(whole(F.col("embedding"), dimensions))
    rows = kept.select("vec_id", quantised(F.col("embedding"), scale).alias("vector"))
    distinct = common.settle(rows.groupBy("vector").agg(F.count("*").alias("weight")), "vectors")
    centroids = first_centroids(kept, k, scale, seed).reshape(-1, dimensions)
    if not len(centroids):
        return rows.limit(0).selectExpr("vec_id", "cast(null as int) cluster", "cast(null as long) distance", "cast(null as long) cluster_inertia", "cast(null as long) inertia", "vector centroid", "cast(null as string) centroid_sha256")
    for _ in range(rounds):
        centroids = moved(distinct, centroids)
    assigned = common.settle(distinct.mapInArrow(_assigned(centroids), "vector array<int>, weight long, cluster int, distance long"), "assigned")
    common.discard(distinct)
    inertia = dict(assigned.groupBy("cluster").agg(F.sum(F.col("weight") * F.col("distance"))).collect())  # a row a centroid
    total = assigned.agg(F.sum("weight")).first()[0]
    return _told(_back(rows, assigned, total), centroids, inertia)


def _back(rows: DataFrame, assigned: DataFrame, total: int) -> DataFrame:
    """(vec_id, cluster, distance): assignments of distinct vectors joined to all rows; those of very common ones are few and sent to every task."""
    found = assigned.select(F.col("vector").alias("of"), "cluster", "distance", (F.col("weight") * HOT > F.greatest(F.lit(total), F.lit(50 * HOT))).alias("hot"))
    hot = F.broadcast(found.where("hot"))  # fewer than HOT rows, by their weights
    same = (F.xxhash64("vector") == F.xxhash64("of")) & (F.col("vector") == F.col("of"))
    many = rows.join(hot, F.col("vector") == F.col("of"))
    others = rows.join(hot.select("of"), F.col("vector") == F.col("of"), "left_anti").join(found.where("not hot"), same)
    return many.select("vec_id", "cluster", "distance").unionByName(others.select("vec_id", "cluster", "distance"))


def _told(found: DataFrame, centroids: np.ndarray, inertia: dict[int, int]) -> DataFrame:
    each = F.lit([inertia.get(c, 0) for c in range(len(centroids))]).cast("array<long>")
    names = F.lit([sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids])
    at = F.col("cluster") + 1
    centroid = F.element_at(F.lit([",".join(map(str, c.tolist())) for c in centroids]), at)
    return found.select(
        "vec_id", "cluster", "distance", F.element_at(each, at).alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.transform(F.split(centroid, ","), lambda x: x.cast("int")).alias("centroid"), F.element_at(names, at).alias("centroid_sha256"),
    )

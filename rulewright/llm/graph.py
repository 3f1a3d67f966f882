"""Connected components of an undirected graph, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the least neighbour of u, u itself included.

    The minimum is an aggregate with partial sums, and the join that brings it
    back to the pairs is one that Spark splits where a u is very frequent.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) of every node that `edges` (a, b) name; root is the smallest node reachable.

    Alternates the large-star and small-star steps; each round is written to
    the shared folder, so neither the lineage nor the driver grows.  Loops
    and repeated edges do no harm, edges with a null are left out, and no
    edges give no rows.
    """
    now = common.settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    loops = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    last = None
    for _ in range(most):
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first())
        if state == last or not state[0]:
            break
        last = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)
        kept = small.select(F.col("u"), F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = common.settle(kept.where("u <> v").distinct(), "edges")
    else:
        raise RuntimeError(f"no fixed point in {most} rounds")
    roots = now.select(F.col("v").alias("node")).unionByName(loops).distinct().join(now.select(F.col("u").alias("node")), "node", "left_anti")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))

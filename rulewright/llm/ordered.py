"""Shards of documents in ascending order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def bounds(ids: DataFrame, n: int) -> list[int]:
    """The first id of each of at most `n` shards about as large; each is an id that exists.  Reads the ids alone."""
    got = ids.agg(F.percentile_approx("doc_id", F.array(*[F.lit(k / n) for k in range(n)]), 10 * max(n, 1000)).alias("b"), F.min("doc_id").alias("least")).first()
    return sorted({got["least"], *got["b"]}) if got["b"] else []


def _at_most(values: list, id_: Column) -> Column:
    return F.size(F.filter(F.lit(values), lambda b: b <= id_))


def shard_of(firsts: list[int], id_: Column) -> Column:
    """Number of the shard of an id: its place among `firsts`, found in two steps of about sqrt(len(firsts)) comparisons; a null id is in the first."""
    if len(firsts) <= 64:
        return F.greatest(_at_most(firsts, id_) - 1, F.lit(0))
    width = int(len(firsts) ** 0.5) + 1
    rows = [firsts[k : k + width] for k in range(0, len(firsts), width)]
    row = F.greatest(_at_most([r[0] for r in rows], id_) - 1, F.lit(0))
    return F.greatest(row * width + F.size(F.filter(F.element_at(F.lit(rows), row + 1), lambda b: b <= id_)) - 1, F.lit(0))


def in_order(docs: DataFrame, each: int, peek: bool = False, most: int = 20_000) -> tuple[DataFrame, int]:
    """(doc_id, text, shard, peek) with each partition one shard, sorted by doc_id, then text; and the number of shards.

    With `peek`, a shard also ends with the rows of the next shard's first id
    (the last: of the first shard's), marked so.
    """
    whole = common.texts(docs)
    firsts = bounds(docs.select(F.col("doc_id").cast("long").alias("doc_id")), common.shards(docs, each, most))
    n = max(1, len(firsts))
    if not firsts:
        return whole.select("*", F.lit(0).alias("shard"), F.lit(False).alias("peek")).coalesce(1), 1
    dealt = whole.withColumn("shard", shard_of(firsts, F.col("doc_id")))
    if peek:
        here, back = F.struct("shard", F.lit(False).alias("peek")), F.struct(F.pmod(F.col("shard") - 1, F.lit(n)).alias("shard"), F.lit(True).alias("peek"))
        first = F.array_contains(F.lit(firsts), F.col("doc_id")) if n <= 64 else F.col("doc_id") == F.element_at(F.lit(firsts), F.col("shard") + 1)
        dealt = dealt.select("doc_id", "text", F.inline(F.when(first, F.array(here, back)).otherwise(F.array(here))))
    else:
        dealt = dealt.withColumn("peek", F.lit(False))
    return dealt.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "peek", "doc_id", "text"), n

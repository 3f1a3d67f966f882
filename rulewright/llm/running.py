"""Places and prefix sums along an order, without a task that sees all rows.

Rows are dealt by ranges of the order and written to the shared folder, so
that the ranges stay what they are.  One row a range then tells what lies
before it: that is all that a single task ever reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def placed(df: DataFrame, *by: Column, parts: int | None = None) -> DataFrame:
    """`df`, settled, with `_part` and `_place`: the number of a range of the order `by`, and the row's place in it from 0.

    Rows that are equal in the order may lie in two ranges, so a third of all
    rows may be equal without meeting in one task.
    """
    tie = F.col("_tie")
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts, *by, tie) if parts else dealt.repartitionByRange(*by, tie)
    dealt = common.settle(dealt.sortWithinPartitions(*by, tie).drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "places")
    return dealt.withColumns({"_part": F.shiftright("_at", _BITS), "_place": F.col("_at").bitwiseAND((1 << _BITS) - 1)}).drop("_at")


def numbered(df: DataFrame, *by: Column, parts: int | None = None, name: str = "rank") -> DataFrame:
    """`df` with the place of each row, from 0, in the order `by`."""
    dealt = placed(df, *by, parts=parts)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_before"))  # a row a range
    return dealt.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))


def summed(df: DataFrame, *by: Column, parts: int | None = None, **sums: Column) -> DataFrame:
    """`df` with, for each of `sums`, the sum over all rows before this one in the order `by`."""
    dealt = placed(df, *by, parts=parts)
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_part").agg(*[F.sum(x).alias(f"_{n}") for n, x in sums.items()])  # a row a range
    starts = totals.select("_part", *[F.coalesce(F.sum(f"_{n}").over(along), F.lit(0)).alias(f"_{n}") for n in sums])
    own = dealt.select("*", *[F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(n) for n, x in sums.items()])
    return own.join(F.broadcast(starts), "_part").select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])

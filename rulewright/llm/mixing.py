"""Mixing sources to target weights.

Every source has a target in words: its weight's share of all words, though no
more than a given multiple of what it has, the excess going to the others by
weight.  A document's place in its source is a hash of its id; words are summed
along that order and the mix ends exactly at the target, in the midst of a
document if need be.  Where the target exceeds the source, the order is gone
through again.

Column expressions only.  A source's hash range is cut into buckets by how many
rows it has, so a source with a third of all rows is many buckets, and prefix
sums are taken within buckets after one row a bucket has told what lies before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, running

WEIGHTS = (5, 2, 1)
#: A source gives its words at most so many times.
MOST = 3
#: Buckets over all sources, at least; and rows of a bucket, about, at most.
BUCKETS, BUCKET_ROWS = 2048, 1_000_000
_KEY_BITS = 60


def words(text: Column) -> Column:
    """How many words a text has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def _key(doc_id: Column, text: Column) -> Column:
    """60 bits that order a source at random, the same in each run; a null id goes by its text."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), name)), 1, _KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`sources` (source, source_size and others) with rank, weight and target in words.

    Sources go by code point, null last, and weigh `weights` in turn.  With caps
    c and weights w the targets are min(c, level * w), where the level makes
    them add up to all words: for any set K of sources held at their caps, the
    caps of K and the level's share of the rest are no less than the sum of the
    targets, so level >= (all - caps of K) / (weights of the rest), with
    equality for the right K.  That is a prefix in ascending order of c / w, so
    the level is the greatest of those quotients over all prefixes.
    """
    ranked = running.numbered(sources, F.col("source").asc_nulls_last())
    ranked = ranked.withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    cap = F.col("source_size") * most
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    along = running.summed(ranked, (cap / F.col("weight")).asc(), F.col("rank").asc(), _caps=cap, _weights=F.col("weight"))
    quotient = (F.lit(total or 0) - F.col("_caps")).cast("double") / (F.lit(weight or 0) - F.col("_weights")).cast("double")
    level = along.agg(F.max(quotient)).first()[0] or 0.0
    return ranked.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight").cast("double")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, budget, taken) of every row of `docs` (doc_id, source, text).

    `taken` is how many words of the document the mix takes, a word taken twice
    counted twice: `budget`, the target rounded, of each source in all, and at
    most `most` times the document's size.  A null source is a source of its
    own, a null or empty text has size 0 and is taken 0 times, equal ids within
    a source are ordered by size, and repeated rows each get a row and share the
    words as any two documents would.  Rows without an id are placed by the hash
    of their text.  If no text has a word all targets are 0; an empty table
    gives no rows, and other columns are left behind.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), _key(F.col("doc_id"), F.col("text")).alias("key"))
    rows = common.settle(rows, "sizes")
    sources = targets(rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")), weights, most)
    all_rows = rows.count()
    cut = max(BUCKETS, -(-all_rows // BUCKET_ROWS))
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most)
    sources = sources.withColumns({"budget": budget, "buckets": F.ceil(F.col("rows") * cut / F.lit(max(1, all_rows)))})
    sources = common.settle(sources.select("source", "rank", "source_size", "target", "budget", "buckets"), "sources")

    # Spark sees how small the settled table is and broadcasts it, or else splits what is skewed of the join.
    theirs = sources.withColumnRenamed("source", "of")
    bucket = F.least(F.floor(F.col("key").cast("double") * F.col("buckets") / F.lit(float(1 << _KEY_BITS))), F.col("buckets") - 1)
    dealt = rows.join(theirs, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", bucket).drop("of", "buckets")
    sums = dealt.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("rank", "bucket", before.alias("start"))
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    along = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["rank", "bucket"])
    laps = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    left = F.col("budget") - laps * F.col("source_size") - F.col("start") - F.col("inside")
    taken = laps * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return along.select("doc_id", "source", "size", "source_size", "target", "budget", taken.cast("long").alias("taken"))

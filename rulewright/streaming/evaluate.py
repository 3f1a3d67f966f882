"""Rule evaluation on streams: an extension, as evaluation has no state.

A stream of filings goes through the same expressions as a table.  What needs
state is bounded by a watermark: rule ingestion drops ids seen within it, and
pass rates are sums over tumbling windows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.rules import Rule, Ruleset
from ..plans.schema import Schema


def fresh_rules(records: DataFrame, key: str = "rule_id", time: str = "ts", within: str = "1 hour") -> DataFrame:
    """The records whose key did not come before within the watermark."""
    return records.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def pass_rates(results: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Passed and all results of each rule in tumbling windows; results later than `late` are not counted."""
    w = F.window(time, width)
    sums = results.withWatermark(time, late).groupBy(w.alias("w"), "id").agg(F.count_if("passed").alias("passed"), F.count("*").alias("results"))
    return sums.select(F.col("w.start").alias("from"), "id", "passed", "results")


def demonstration(spark: SparkSession, path: str) -> DataFrame:
    """Pass rates of two rules over a stream of the events table, run until what is there is used up."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    rules = Ruleset("events", Schema.of(k="Nat"), (Rule("small", "k at most 50", "1", "k <= 50", "large"), Rule("even", "k is even", "2", "k % 2 = 0", "odd")))
    filings = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0)).alias("k"))
    long = filings.select("ts", F.inline(F.array(*[F.struct(F.lit(r.id).alias("id"), F.expr(r.check).alias("passed")) for r in rules.rules])))
    out = f"{scratch(spark)}/rates-{uuid.uuid4().hex}"
    # Rates of all windows each time; the last batch leaves the whole result.
    rates = pass_rates(long, width="1 day").writeStream.outputMode("complete")
    rates.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.date_format("from", "yyyy-MM-dd").alias("day"), "id", "passed", "results")


class Ingestion:
    """Rule records that arrive in batches, each id once: a stream over a folder, append mode, with its state and progress in the folder beside it.

    Of the records of an id the first counts; those that come while it is
    remembered are dropped, as are records older than the watermark, which runs
    `within` behind the newest record.  An id is forgotten once the watermark
    has passed its record by `within`, so the state holds no more ids than come
    in twice that time.  A job that dies goes on from the last whole batch.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "rule_id", time: str = "ts", within: str = "1 hour") -> None:
        self.spark, self.path, self.schema, self.key, self.time, self.within = spark, path.rstrip("/"), schema, key, time, within

    def arrive(self, records: DataFrame) -> None:
        """Puts a batch where the stream looks, and runs the stream over all that has not been read."""
        records.write.mode("append").parquet(f"{self.path}/arriving")
        self.run()

    def run(self) -> None:
        """Reads what has arrived; without anything new, nothing happens."""
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.path}/arriving")
        fresh = fresh_rules(stream, self.key, self.time, self.within)
        fresh.writeStream.outputMode("append").format("parquet").option("path", f"{self.path}/accepted").option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start().awaitTermination()

    def accepted(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/accepted")


def scratch(spark: SparkSession) -> str:
    """A folder that all of the cluster reaches: ``spark.checkpoint.dir``, or one of this machine where all of Spark runs on it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (at or tempfile.mkdtemp(prefix="stream-")).rstrip("/")

"""What the operators of this subpackage share: tables, texts and the shared folder."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at these; the contracts write them ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


def _importable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it runs from a checkout instead of an installation."""
    at, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if at not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), at) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of documents that a Python worker is handed at once.  Spark's 10,000 would be tens of MB of text, several times over.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bounds what a worker holds of long texts; a smaller setting of the session's own stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def merged(batches, rows: int = 1 << 14):
    """Arrow batches of short rows put together again, so that array operations have something to work on."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def tidily(run):
    """`run`, a function of Arrow batches, that gives freed memory back to the system at its end: workers go on to other stages."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # not in every C library
                ctypes.CDLL(None).malloc_trim(0)

    return tidy


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the columns named; whatever else a table holds is left behind here, whatever its name."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, as ``spark.checkpoint.dir`` names it.

    Where it is unset, one of our own if all of Spark runs on this machine, as
    in tests; elsewhere an error, as executors would write to disks of their own.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/rulewright/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows of `df`, written to the shared folder and read again: a cut of the lineage that outlives executors."""
    spark, at = df.sparkSession, new_dir(df.sparkSession, name)
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._settled_at = at
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the folders of settled tables that nothing reads any more, and lets Spark drop the shuffles behind them."""
    for df in tables:
        if at := getattr(df, "_settled_at", None):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


@contextmanager
def split_finely(spark: SparkSession, parts: int):
    """Lets scans planned inside make `parts` tasks or more, where small files would go to one task for each core."""
    name = "spark.sql.files.minPartitionNum"
    had = spark.conf.get(name, None)
    spark.conf.set(name, max(parts, spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(name) if had is None else spark.conf.set(name, had)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: of a file scan, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shards(df: DataFrame, each: int = 64 << 20, most: int = 100_000) -> int:
    """How many parts of about `each` bytes `df` makes."""
    return max(1, min(most, -(-input_bytes(df) // each)))


def remainder(column: str, modulus: int):
    """crc32 of an id's decimal digits modulo `modulus`: the folds of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus

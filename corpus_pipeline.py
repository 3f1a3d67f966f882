"""A training-corpus pipeline out of the operators of ``rulewright.llm``.

Each stage takes the documents that its predecessor kept (same columns as
`documents`), and the last one packs them into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulewright.llm import common, decontaminate, langid, packing, secrets, simhash
from rulewright.llm.queries import tokenizer_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is not rejected; learns from those that are labelled."""
    return langid.identify(docs).where(~F.col("rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies (five-word shingles, similarity 0.8): the one with the smallest doc_id.

    Of rows with one doc_id and text the one stays whose other columns, as
    JSON, come first; rows with one doc_id and different texts are documents of
    their own, and a null doc_id comes after all others.
    """
    firsts = simhash.near_copies(docs).where("first").select(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("hash").alias("_hash"))
    # Written first, so that Spark knows how few they are before it moves texts.
    kept = common.settle(firsts.groupBy("_none", "_id", "_hash").agg(F.count("*").alias("_rows")), "kept")
    key = {"_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_hash": F.xxhash64(F.coalesce("text", F.lit("")))}
    left = docs.withColumns(key).join(kept.where("_rows = 1"), [*key], "left_semi").select(*docs.columns)
    if kept.where("_rows > 1").isEmpty():
        return left
    again = docs.withColumns(key).join(kept.where("_rows > 1"), [*key], "left_semi")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    one = Window.partitionBy(*key).orderBy(F.to_json(F.struct(F.lit(0).alias("_none"), *rest)))
    return left.unionByName(again.withColumn("_number", F.row_number().over(one)).where("_number = 1").select(*docs.columns))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; all documents stay."""
    return secrets.without_secrets(docs, tokenizer_path("byte_bpe_50k.tiktoken"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No stage but the last could be put in SQL; `tests/llm` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again for the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The thin queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, centroidsql, decontaminate, langid, merkle, merklesql, mixing, mixsql, packing, passages, pitmanyor, prefixhash, secrets, simhash, urlfilter, urlsql, wavelet
from .common import remainder, table


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; RULEWRIGHT_TOKENIZERS may name another folder."""
    if at := os.environ.get("RULEWRIGHT_TOKENIZERS"):
        return f"{at}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    found = langid.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) != 2)


def op8_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


URL_RULES = [urlfilter.rule("block", "net/"), urlfilter.rule("allow", "example.net/en/"), urlfilter.rule("block", "example.com/de/"), urlfilter.rule("allow", "org/fr/")]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixhash.fingerprints(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op9_url_filters": urlsql.oracle(URL_RULES), "op11_centroid_clustering": centroidsql.oracle(), "op12_mix_sources": mixsql.oracle(), "op13_merkle_manifest": merklesql.oracle()}

"""One query per operator over its whole table, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    decontaminate, extract, language, merkle, mixing, quality, sharding, simhash, suffixes, tokens, topk,
    warc, whitening,
)
from parcelflow.llm.common import table

SHARDS = 8
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabularies are installed; the package comes with them."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS)


def op2_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op3_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(table(spark, sf_dir, "pages"))


def op7_ngram_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predicted(docs, language.learn(docs))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_plan(table(spark, sf_dir, "documents"))


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.EXACT_64)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op12_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_kd_sharding, op2_rule_quality, op3_histogram_topk, op4_suffix_repeats, op5_template_decontamination,
        op6_text_density, op7_ngram_bitmask, op8_source_mixing, op9_simhash_bktree, op10_token_files, op11_merkle_manifest,
        op12_incremental_whitening, op13_warc_revisits,
    )
}

LLM_SQL: dict[str, str] = {
    "op3_histogram_topk": topk.ORACLE_SQL, "op8_source_mixing": mixing.ORACLE_SQL, "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op13_warc_revisits": warc.ORACLE_SQL,
}

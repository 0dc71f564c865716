"""From raw documents to mixed, sharded training documents, in five stages.

run() writes each stage's rows as Parquet in the shared folder and reads them again as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import decontaminate, mixing, quality, sharding, simhash
from parcelflow.llm.common import staged, table

SHARDS = 8


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rule ensemble, learnt from the labelled rows of docs, accepts."""
    return quality.accepted(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose SimHash fingerprints (three-word shingles, 64 bits) link at 3 or fewer bits."""
    return simhash.one_per_group(docs, simhash.EXACT_64)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, verbatim or re-parameterised."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the weights of their sources take them."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the shard that holds each."""
    return sharding.sharded(docs, sharding.build_tree(docs, SHARDS))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The fit, the hashes and the trees have no form in DuckDB's SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

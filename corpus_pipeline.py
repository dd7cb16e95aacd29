"""A training corpus from raw documents: five stages, each a table that the next one reads."""

from pyspark.sql import DataFrame, SparkSession

from territory_analytics.llm import decontaminate, mixing, quality, simhash, tokens
from territory_analytics.llm.common import table
from territory_analytics.storage import durable


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash.keep_one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that mostly consist of them go."""
    return decontaminate.remove_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target of their source serves them."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of token ids, and what they hold of each document."""
    return tokens.encode_and_read(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_planes", token_files),
]

#: SQL cannot train the classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs

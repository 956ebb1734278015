"""The corpus pipeline: five stages, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import decontaminate, mixing, near_dups, quality_rules, sharding
from kindred.shared import ship_package, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the strict policy passes; judged in place, so no join and no shuffle."""
    return quality_rules.passing(docs, quality_rules.STRICT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    ship_package(spark)
    return near_dups.deduplicated(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    ship_package(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.sampled(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every row: shard and slot."""
    placed = sharding.assign(docs)
    return placed.selectExpr("doc_id", "size", "text_crc32", "'key' AS law", "shard", "slot", "grown_shard")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality), ("near-duplicates", near_duplicates), ("decontamination", contamination),
    ("source mixing", mixture), ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None

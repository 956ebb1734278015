"""The registered queries of the numbered operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import (
    ctw,
    decontaminate,
    html_extract,
    licenses,
    merkle_manifest,
    mixing,
    near_dups,
    pii,
    quality_rules,
    sharding,
    substring_dups,
    token_alignment,
    url_filter,
)
from kindred.shared import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all rules, the base verdict and the verdict of the strict policy."""
    ledger = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    judged = quality_rules.judge(ledger, quality_rules.BASE, "base_passed")
    judged = quality_rules.judge(judged, quality_rules.STRICT, "kept")
    return judged.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "NOT base_passed AS base_failed",
        "kept", "fail_bits",
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(_table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled(spark))
    return url_filter.judge(_table(spark, sf_dir, "pages"), model)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"))
    return placed.selectExpr("doc_id", "size", "text_crc32", "'key' AS law", "shard", "slot", "grown_shard")


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.groups(_table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(_table(spark, sf_dir, "documents")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.check(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(_table(spark, sf_dir, "documents"))


def op11_substring_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dups.repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.checked(merkle_manifest.manifest(_table(spark, sf_dir, "documents")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.score(_table(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_quality_rules, op2_pii, op3_mixing, op4_html_extract, op5_url_filter, op6_sharding, op7_near_dups, op8_licenses,
        op9_decontaminate, op10_ctw, op11_substring_dups,
        op12_merkle_manifest, op13_token_alignment,
    )
}

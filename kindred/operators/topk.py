"""Top-k per query, ties to the smaller id, and the lookup of the ranked items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from kindred import constants as K
from kindred.operators.scorers import MAIN, RANK_DIGITS
from kindred.shared import stored


def best_first(score: str = "score", item: str = "item_id") -> list[Column]:
    return [F.round(score, RANK_DIGITS).desc(), F.col(item).asc()]


def check_k(k: int, most: int | None = None) -> int:
    if k < K.USER_K_MIN or (most is not None and k > most):
        raise ValueError(f"k must be between {K.USER_K_MIN} and {most or 'any size'}")
    return k


def topk_per_query(scored: DataFrame, k: int) -> DataFrame:
    """Rank rows of (query_id, item_id, score); Spark cuts each task to k rows first."""
    window = W.partitionBy("query_id").orderBy(*best_first())
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def repeated(lists: DataFrame, times: Column, k: int) -> DataFrame:
    """The same lists where every row stands ``times`` times, cut to k rows again."""
    more = lists.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), times.cast("bigint"))))
    return topk_per_query(more.select("query_id", "item_id", "score"), k)


def merge_topk(partials: DataFrame, k: int, fan_in: int = 16) -> DataFrame:
    """Merge the partial lists of all tasks into one list per query and kind.

    With many input partitions one query would get k rows from each of them in a single
    task, so a salted first round cuts every query to ``fan_in * k`` rows. Both rounds are a rank
    below a limit and nothing else, so Spark cuts every task's rows before it shuffles them.
    """
    salt = F.pmod(F.xxhash64("item_id"), F.lit(fan_in)).alias("salt")
    lists = W.partitionBy("query_id", "kind")
    cut = _best(partials.select("query_id", "kind", "item_id", "score", salt), W.partitionBy("query_id", "kind", "salt"), k)
    return _best(cut, lists, k).select("query_id", "kind", "rank", "item_id", "score")


def _best(rows: DataFrame, lists: WindowSpec, k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(lists.orderBy(*best_first()))).where(F.col("rank") <= k)


def eligible_items(partials: DataFrame, kind: int) -> DataFrame:
    """(query_id, eligible): how many items could have entered a query's list."""
    return partials.where(F.col("kind") == kind).groupBy("query_id").agg(F.sum("eligible").alias("eligible"))


def ranked(merged: DataFrame) -> DataFrame:
    """The main list as (query_id, rank, item_id, score)."""
    return merged.where(F.col("kind") == MAIN).select("query_id", "rank", "item_id", "score")


def lookup(results: DataFrame, texts: DataFrame) -> DataFrame:
    """Attach item columns to ranked rows; ``rank`` keeps the order, a row without its item has NULLs.

    The results are stored first. Spark then knows their true size and broadcasts their ids when
    they are few, so that the item table is not shuffled for a few rows; what it finds is as small.
    """
    return attach(stored(results, "results"), texts)


def attach(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The same for rows that are stored already."""
    found = texts.join(rows.select("item_id").distinct(), "item_id", "left_semi")
    return rows.join(found, "item_id", "left")

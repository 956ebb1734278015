"""The user search: complete queries, facet limits per query, gate, ranking, links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators.facets import QUERY_LIMITS, FacetFilter, complete_query, enough_candidates, with_limits
from kindred.operators.range_grid import QueryLimits
from kindred.operators.scan import scan_topk
from kindred.operators.scorers import MAIN, DenseScoring
from kindred.operators.topk import attach, check_k, eligible_items, merge_topk, ranked, repeated
from kindred.plans.text_search import QUERY_FIELDS
from kindred.plans.vector_search import EmbeddingIndex
from kindred.shared import scratch, spread, stored

RESULT = ["query_id", "status", "rank", "item_id", "score", "url"]


def filtered_search(
    queries: DataFrame,
    index: EmbeddingIndex,
    items_text: DataFrame,
    k: int = K.USER_K_DEFAULT,
    least: int = K.MIN_CANDIDATES,
    limits: QueryLimits = QUERY_LIMITS,
    demote: float = K.RESTRICTED_DUPLICATE,
    k_max: int | None = None,
) -> DataFrame:
    """One row per result, and one row with a status for each query without results.

    Every query brings its own limits. One scan of the items per block of queries counts each query's candidates and keeps
    its k best of them; pairs of queries and candidates, which may be most of all pairs, are never stored. A query
    without enough candidates loses its list. A query that stands in its table m times meets every candidate m * m times
    (an item that stands in the index n times, n * n times), as in a join of pairs with queries and items.
    """
    check_k(k, k_max)
    fields = [f for f in QUERY_FIELDS if f in queries.columns]
    with scratch(queries.sparkSession) as keep:
        ready = with_limits(queries.where(complete_query(*fields)))
        asked = stored(index.asked(ready, limits.query_columns()), "asked")
        same = asked.where(F.col("query_id").isNotNull()).groupBy(*asked.columns).agg(F.count("*").alias("_times"))
        once = stored(limits.ready(same).withColumn("_row", F.monotonically_increasing_id()), "once")
        rows = once.select("query_id", "_times", "_row")
        scoring = DenseScoring(demote=demote, limits=limits)
        items = spread(index.vectors.where(F.col("item_id").isNotNull()), "item_id")
        asking = once.drop("query_id", "_times").withColumnRenamed("_row", "query_id")
        partials = stored(scan_topk(items, asking, scoring, k), "partials")
        counts = eligible_items(partials, MAIN).withColumnRenamed("query_id", "_row").join(rows, "_row")
        enough = counts.groupBy("query_id").agg(F.sum(F.col("eligible") * F.col("_times")).alias("n")).where(F.col("n") >= least)
        best = ranked(merge_topk(partials, k)).withColumnRenamed("query_id", "_row").join(rows, "_row")
        kept = best.join(enough.select("query_id"), "query_id", "left_semi")
        copies = F.count("*").over(W.partitionBy("_row", "item_id"))
        top = repeated(kept.withColumn("_copies", copies), F.col("_times") * F.col("_times") * F.col("_copies"), k)
        found = keep(top.select("query_id", "rank", "item_id", "score"), "found")
    return _answers(queries, fields, found, items_text)


def _answers(queries: DataFrame, fields: Sequence[str], found: DataFrame, items_text: DataFrame) -> DataFrame:
    """The hits with their links (NULL where an item has none), and a status row for every other query.

    A query without any hit row either was incomplete or had too few candidates.
    """
    hits = attach(found, items_text.select("item_id", "url")).withColumn("status", F.lit("ok"))
    reason = F.when(complete_query(*fields), "too_few_candidates").otherwise("incomplete_query")
    empty = queries.select("query_id", reason.alias("status")).join(
        found.select("query_id").distinct(), "query_id", "left_anti"
    )
    return hits.select(*RESULT).unionByName(empty, allowMissingColumns=True)


def search_with_filter(
    queries: DataFrame,
    index: EmbeddingIndex,
    facet_filter: FacetFilter,
    items_text: DataFrame,
    k: int = K.USER_K_DEFAULT,
    least: int = K.MIN_CANDIDATES,
    facets: DataFrame | None = None,
    k_max: int | None = None,
) -> DataFrame:
    """The same rows with one shared filter, pushed into the scan.

    A filter that is too strict gives every complete query the status ``too_few_candidates``.

    Facets beside the vectors make the filter a predicate; a separate ``facets`` table
    makes it a semi join.
    """
    check_k(k, k_max)
    fields = [f for f in QUERY_FIELDS if f in queries.columns]
    source = index.vectors if facets is None else facets
    if not enough_candidates(facet_filter.candidates(source), least):
        none = queries.sparkSession.createDataFrame([], f"{_kind(queries)}, rank int, item_id long, score double")
        return _answers(queries, fields, none, items_text)
    ready = queries.where(complete_query(*fields))
    if facets is None:
        narrowed = EmbeddingIndex(index.vectors.where(facet_filter.predicate()), index.factory)
        top = narrowed.search(ready, k)
    else:
        top = index.search(ready, k, candidates=facet_filter.candidates(facets))
    return _answers(queries, fields, stored(top, "found"), items_text)


def _kind(queries: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}"

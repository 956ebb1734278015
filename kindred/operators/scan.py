"""Meet items and queries without a cross join, then keep only partial top-k lists.

The queries go out in blocks of checked size, each broadcast for one pass over the items. The
items are never shuffled. With several blocks, the items are stored first, so that no pass makes them anew; the
lists of a block are stored and its broadcast is released before the next one is read, so no side has to fit anywhere whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.scorers import PARTIAL_SCHEMA, Scoring, rank_batches
from kindred.shared import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, scratch, stored, stored_all, table_dir

def row_bytes(table: DataFrame) -> Column:
    """About what a row takes in memory, every column counted."""

    def size(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.StringType):
            return F.octet_length(column)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            lengths = F.transform(column, lambda x: F.coalesce(F.octet_length(x), F.lit(0)) + 8)
            return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)
        return F.size(column) * 8 if isinstance(kind, T.ArrayType) else F.lit(8)

    return reduce(add, [F.coalesce(size(f), F.lit(0)).cast("long") for f in table.schema.fields])


def table_size(table: DataFrame) -> tuple[int, int]:
    """Rows, and the bytes they hold in all."""
    row = table.agg(F.count("*"), F.sum(row_bytes(table))).first()
    return row[0], row[1] or 0


def repeated_ids(table: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, n): ids that stand in a table more than once; NULL counts as an id."""
    return table.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def scan_topk(
    items: DataFrame,
    queries: DataFrame,
    scoring: Scoring,
    k: int,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Partial top-k rows (``PARTIAL_SCHEMA``) for :func:`kindred.operators.topk.merge_topk`.

    ``item_id`` and ``query_id`` are whole numbers, each once in its table; a repeated query is an
    error, repeated items can be found with :func:`repeated_ids`. A task that is
    run again gives the same rows, as a list depends on scores and ids only. A block larger
    than ``max_rows`` or ``max_bytes`` arises only where a single query is larger, and none is larger than
    what may be broadcast, whatever the caller allows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    items = items.select("item_id", *scoring.columns())
    max_rows, max_bytes = min(max_rows, MAX_BROADCAST_ROWS), min(max_bytes, MAX_BROADCAST_BYTES)
    # The queries are read once for their size and once by blocks, but encoded once.
    queries = queries.persist()
    try:
        n_rows, n_bytes = table_size(queries)
        if queries.select("query_id").distinct().count() != n_rows:
            raise ValueError("query_id must stand in its table once")
        if n_rows <= max_rows and n_bytes <= max_bytes:
            return _scan(items, _shared(queries), scoring, k)
        # A tenth more blocks than needed: the hash does not deal them out quite evenly.
        blocks = math.ceil(1.1 * max(n_rows / max_rows, n_bytes / max_bytes))
        path = table_dir(items.sparkSession, "partials")
        with scratch(items.sparkSession):
            return stored_all(_passes(stored(items, "items"), queries, scoring, k, blocks), path)
    finally:
        queries.unpersist()


def _passes(items: DataFrame, queries: DataFrame, scoring: Scoring, k: int, blocks: int) -> Iterator[DataFrame]:
    """One pass over the items per block; the caller has stored a pass when it asks for the next."""
    of_query = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for block in range(blocks):
        shared = _shared(queries.where(of_query == block))
        yield _scan(items, shared, scoring, k)
        shared.destroy()


def _shared(block: DataFrame) -> Broadcast[pa.Table]:
    return block.sparkSession.sparkContext.broadcast(block.toArrow())


def _scan(items: DataFrame, shared: Broadcast[pa.Table], scoring: Scoring, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rank_batches(batches, scoring.bind(shared.value), k)

    return items.mapInArrow(run, PARTIAL_SCHEMA)

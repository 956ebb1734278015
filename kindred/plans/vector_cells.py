"""Exact nearest vectors over cells: every item lies with its nearest pivot, and its distance to it is stored.

Between unit vectors the chord length is a metric and falls as the cosine rises. For a query at distance ``q`` from a
pivot, items of that pivot at distances ``least .. greatest`` are no nearer than ``max(q - greatest, least - q)``.
A search visits each query's nearest cells until they hold k items; the k-th cosine found there is a radius. Other
cells are visited only if they can hold something inside the radius, and in them only the ring of items whose own
distance to the pivot differs by no more than that. Nothing else is read, and the result is exact.

Pivots are a bounded sample; the index holds every item. Table rows lie in the order of cell and distance. A search is two
scans of them per block of queries, in which the items of a cell meet, as one matrix product, the queries that visit it;
pairs of queries and cells are not stored, as there are many where nothing can be ruled out. Vectors without a length are no nearer than a right angle to anything: they have a
cell of their own, -1, and a query without a length visits every cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.vectors import norm
from kindred.operators.scan import scan_topk
from kindred.operators import scorers
from kindred.operators.scorers import MAIN, NOT_ELIGIBLE, NearCosines, Room, cosine_error, vector_matrix
from kindred.operators.topk import check_k, merge_topk, ranked, repeated, topk_per_query
from kindred.shared import scratch, stored

MAX_PIVOTS = 1024
RIGHT_ANGLE = 2.0**0.5  # chord length of cosine 0
BOUNDS = 1024  # queries whose bounds are held at a time
SLACK = 1e-6  # chords closer than this count as equal; results rank by nine digits of the cosine


def _unit(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and which rows have a length; the others are zeros."""
    if not dim:  # no pivot, so no vector has a length
        return np.zeros((len(lists), 0)), np.zeros(len(lists), dtype=bool)
    rows = np.array([np.zeros(dim) if v is None or not len(v) else v for v in lists.to_pylist()], dtype=float).reshape(len(lists), dim)
    length = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(length == 0, 1.0, length)[:, None], length > 0


def _chords(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T)))


def _placed(items: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``item_id, embedding, cell, distance``."""
    shared = items.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, real = _unit(batch.column("embedding"), shared.value.shape[1])
            chords = np.column_stack((_chords(units, shared.value), np.full(len(units), np.inf)))
            cell = chords.argmin(axis=1)
            distance = np.where(real, chords[np.arange(len(cell)), cell], RIGHT_ANGLE)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.where(real, cell, -1).astype(np.int32)), pa.array(distance)],
                [*batch.schema.names, "cell", "distance"],
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in items.dtypes)
    return items.mapInArrow(run, f"{schema}, cell int, distance double")


@dataclass(frozen=True)
class CellIndex:
    """vectors (item_id, embedding, norm, cell, distance), and per cell its number of items and range of distances."""

    vectors: DataFrame
    cells: DataFrame
    pivots: DataFrame

    @classmethod
    def fit(cls, items: DataFrame, path: str, n_pivots: int | None = None) -> CellIndex:
        """Build the index of ``item_id, embedding`` rows in a folder; the root of their number as pivots, at most MAX_PIVOTS."""
        spark = items.sparkSession
        rows = items.select("item_id", "embedding", norm(F.col("embedding")).alias("norm"))
        n = n_pivots or max(1, min(MAX_PIVOTS, int(rows.count() ** 0.5)))
        # Four times as many by chance of their id, in case some are equal.
        sample = rows.where("norm > 0").orderBy(F.xxhash64("item_id"), "item_id").limit(4 * n).select("embedding").distinct().limit(n)
        sample.withColumn("cell", F.monotonically_increasing_id()).coalesce(1).write.parquet(f"{path}/pivots")
        pivots = spark.read.parquet(f"{path}/pivots")
        placed = _placed(rows, _pivot_matrix(pivots))
        # One hot cell can be cut at any distance, and at equal distances at any id.
        order = ["cell", "distance", "item_id"]
        placed.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/vectors")
        vectors = spark.read.parquet(f"{path}/vectors")
        cells = vectors.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("least"), F.max("distance").alias("greatest"))
        cells.write.parquet(f"{path}/cells")
        return cls.read(spark, path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CellIndex:
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("vectors", "cells", "pivots")])

    def search(
        self, queries: DataFrame, k: int = K.DEFAULT_K, demote: float | None = None, report: dict | None = None
    ) -> DataFrame:
        """(query_id, rank, item_id, score) by cosine; ``report`` gets the pairs of query and cell visited and possible."""
        check_k(k)
        spark = queries.sparkSession
        with scratch(spark) as keep:
            # Equal rows ask once; one that stands m times meets every item m * m times, as in a join of visits with queries.
            same = queries.where(F.col("query_id").isNotNull()).groupBy("query_id", "embedding").agg(F.count("*").alias("_times"))
            once = stored(same.withColumn("_row", F.monotonically_increasing_id()), "once")
            rows = once.select(F.col("_row").alias("query_id"), "embedding")
            layout = Layout(_pivot_matrix(self.pivots), self.cells.orderBy("cell").toArrow(), k)  # at most MAX_PIVOTS + 1 cells
            items = self.vectors.where(F.col("item_id").isNotNull())
            asked = rows.withColumn("radius", F.lit(None).cast("double"))
            first = stored(ranked(merge_topk(scan_topk(items, asked, CellScoring(layout, demote), k), k)), "first")
            bars = first.where(F.col("rank") == k).select("query_id", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("radius"))
            # A query without k items so far has visited every cell.
            again = stored(rows.join(bars, "query_id"), "again")
            second = ranked(merge_topk(scan_topk(items, again, CellScoring(layout, demote), k), k))
            both = topk_per_query(first.drop("rank").unionByName(second.drop("rank")), k)
            whole = both.withColumnRenamed("query_id", "_row").join(once.select("query_id", "_times", "_row"), "_row")
            found = keep(repeated(whole, F.col("_times") * F.col("_times"), k).select("query_id", "rank", "item_id", "score"), "nearest")
            if report is not None:
                visited = sum(_visits(part, layout).agg(F.sum("cells")).first()[0] or 0 for part in (asked, again))
                report.update(visited=visited, possible=asked.count() * self.cells.count())
            return found


@dataclass(frozen=True)
class Layout:
    """Unit vectors of the pivots, the cells in order with their size and range of distances, and how many items a list holds."""

    pivots: np.ndarray
    cells: pa.Table
    k: int

    def visited(self, units: np.ndarray, real: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Queries and cells: the first cells of queries without a radius, all others it touches for those with one."""
        cell, n, least, greatest = (self.cells.column(c).to_numpy() for c in ("cell", "n", "least", "greatest"))
        out = np.zeros((len(units), len(cell)), dtype=bool)
        if not len(cell):
            return out
        for at in range(0, len(units), BOUNDS):
            some = slice(at, at + BOUNDS)
            # The last column serves the cell -1.
            q = np.column_stack((_chords(units[some], self.pivots), np.full(len(units[some]), RIGHT_ANGLE)))[:, cell]
            bound = np.maximum(0.0, np.maximum(q - greatest, least - q))
            bound = np.where(cell >= 0, bound, RIGHT_ANGLE)
            bound[~real[some]] = 0.0
            order = np.argsort(bound, axis=1, kind="stable")
            before = np.cumsum(n[order], axis=1) - n[order]
            opened = np.empty_like(order, dtype=bool)
            np.put_along_axis(opened, order, before < self.k, axis=1)  # the nearest cells that hold k items
            opened[~real[some]] = True
            later = ~opened & (bound <= radius[some, None] + SLACK)
            out[some] = np.where(np.isnan(radius[some])[:, None], opened, later)
        return out


def _radius(queries: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.asarray(queries.column("radius").to_pylist(), dtype=float)  # NULL is NaN


def _visits(asked: DataFrame, layout: Layout) -> DataFrame:
    """``cells``: how many cells each query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = layout.visited(*_unit(batch.column("embedding"), layout.pivots.shape[1]), _radius(batch))
            yield pa.RecordBatch.from_arrays([pa.array(seen.sum(axis=1), pa.int64())], ["cells"])

    return asked.select("embedding", "radius").mapInArrow(run, "cells long")


@dataclass(frozen=True)
class CellScoring:
    """Cosines of the queries and the items of the cells they visit, of each cell only the ring inside the radius."""

    layout: Layout
    demote: float | None = None

    def columns(self) -> list[str]:
        return ["embedding", "cell", "distance"]

    def bind(self, queries: pa.Table) -> _CellScorer:
        return _CellScorer(self, queries)


class _CellScorer:
    def __init__(self, spec: CellScoring, queries: pa.Table) -> None:
        self.spec = spec
        self.query_ids = queries.column("query_id").to_numpy()
        self.radius = _radius(queries)
        vectors = vector_matrix(queries.column("embedding"))
        length = np.sqrt((vectors * vectors).sum(axis=1))
        self.real, self.units = length > 0, vectors / np.where(length == 0, 1.0, length)[:, None]
        known = self.units if len(spec.layout.pivots) else self.units[:, :0]
        self.visited = spec.layout.visited(known, self.real if len(spec.layout.pivots) else np.zeros(len(known), bool), self.radius)
        self.cells = spec.layout.cells.column("cell").to_numpy()
        self.near = len(self.query_ids) >= scorers._NEAR_QUERIES and not np.isnan(self.units).any()
        if self.near:
            self.single, self.off = self.units.astype(np.float32), cosine_error(self.units)
            self.room = Room(scorers._COSINE_CELLS // len(self.query_ids), len(self.query_ids))
            # What is farther than the radius need not be given again.
            self.least = np.where(np.isnan(self.radius), -np.inf, 1.0 - (self.radius + SLACK) ** 2 / 2)

    def width(self) -> int:
        return len(self.query_ids)

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, NearCosines]]:
        """Cosines in single precision, of the items of one cell at a time."""
        of_item, distance = batch.column("cell").to_numpy(), batch.column("distance").to_numpy()
        items = vector_matrix(batch.column("embedding"), self.units.shape[1])
        length = np.sqrt((items * items).sum(axis=1))
        items = items / np.where(length == 0, 1.0, length)[:, None]
        for cell in np.unique(of_item):
            visited = self.visited[:, np.searchsorted(self.cells, cell)]
            asking = np.flatnonzero(visited)
            if not len(asking):
                continue
            rows = np.flatnonzero(of_item == cell)
            if cell >= 0 and not np.isnan(self.radius[asking]).any():
                # Items outside the rings of all queries are left out.
                q = _chords(self.units[asking], self.spec.layout.pivots[[cell]])[:, 0]
                reach = self.radius[asking] + SLACK
                rows = rows[(distance[rows] >= (q - reach).min()) & (distance[rows] <= (q + reach).max())]
            if 2 * len(asking) > len(visited):  # the others are closed, which is cheaper than a copy
                asking, single, off, least = slice(None), self.single, self.off, np.where(visited, self.least, np.inf)
            else:
                single, off, least = self.single[asking], self.off[asking], self.least[asking]
            for at in range(0, len(rows), len(self.room.cosine)):
                some = rows[at : at + len(self.room.cosine)]
                out = self.room.cosine.ravel()[: len(some) * len(single)].reshape(len(some), len(single))
                cosine = np.matmul(items[some].astype(np.float32), single.T, out=out)
                yield MAIN, some, NearCosines(cosine, off, items[some], self.units, self.room, self.spec.demote, None, asking, least)

    def score(self, batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        out = np.full((batch.num_rows, len(self.query_ids)), NOT_ELIGIBLE)
        of_item, distance = batch.column("cell").to_numpy(), batch.column("distance").to_numpy()
        items = vector_matrix(batch.column("embedding"), self.units.shape[1])
        length = np.sqrt((items * items).sum(axis=1))
        items = items / np.where(length == 0, 1.0, length)[:, None]
        for cell in np.unique(of_item):
            rows = np.flatnonzero(of_item == cell)
            asking = np.flatnonzero(self.visited[:, np.searchsorted(self.cells, cell)])
            if not len(asking):
                continue
            units = self.units[asking]
            cosine = items[rows] @ units.T
            if self.spec.demote is not None:
                cosine[cosine > self.spec.demote] = -1.0
            # All of a first cell is scored, and the zero vectors have no ring.
            if cell >= 0 and not np.isnan(self.radius[asking]).all():
                q = _chords(units, self.spec.layout.pivots[[cell]])[:, 0]
                outside = np.abs(distance[rows][:, None] - q[None, :]) > self.radius[asking][None, :] + SLACK
                cosine[outside] = NOT_ELIGIBLE
            out[np.ix_(rows, asking)] = cosine
        return {MAIN: out}


def _pivot_matrix(pivots: DataFrame) -> np.ndarray:
    """At most MAX_PIVOTS unit vectors, by the number of their cell."""
    rows = [r[0] for r in pivots.orderBy("cell").select("embedding").collect()]
    matrix = np.array(rows, dtype=float).reshape(len(rows), -1) if rows else np.zeros((0, 0))
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))

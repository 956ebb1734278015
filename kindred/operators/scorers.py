"""Task-side helpers: score a batch of items against a bounded block of queries.

Spark decides which items and which query block meet (operators/scan.py) and merges
the partial lists (operators/topk.py). A scorer keeps no pair: it hands one matrix of
at most ``_CELLS`` scores at a time to a running top-k.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kindred.functions.ngrams import Lookup, char_ngrams, word_ngrams
from kindred.operators.range_grid import QueryLimits

_CELLS = 2_000_000
_DENSE_CELLS = 8_000_000
_NEAR_DENSE_CELLS = 32_000_000
_NEAR_OFTEN = 16  # a feature of one query of a group in so many goes through the dense product then
_NEAR_QUERIES = 1_024  # blocks of at least so many queries are scored in single precision first
_NEAR_CELLS = 4_000_000  # scores in single precision at a time
_COSINE_CELLS = 4_000_000  # cosines in single precision at a time
_EXACT_PAIRS = 32_768  # pairs whose vectors are multiplied again in double precision at a time
_NEAR_GROUP = 512  # queries of a group, about, at least; there are 8 kinds of texts by 2 lengths at most
_NEAR_MARKS = 512  # features that tell the kinds apart
_ROWS = 2_000  # items scored at a time, at most: a batch of long texts is not unfolded at once
NOT_ELIGIBLE = -np.inf
RANK_DIGITS = 9  # scores equal to this many digits are ties; the smaller id wins

PARTIAL_SCHEMA = "query_id bigint, kind int, item_id bigint, score double, eligible bigint"
MAIN, FALLBACK = 0, 1


def vector_matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """``list<float>`` column -> (n, dim) doubles; a NULL vector is all zeros."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    dim = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(array), dim))
    full = lengths == dim
    if not (full | (lengths == 0)).all():
        raise ValueError(f"vectors must have {dim} elements")
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(float)
    out[full] = np.nan_to_num(flat.reshape(-1, dim)) if dim else 0.0
    return out


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.float64()).to_numpy(zero_copy_only=False), float)


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(table.schema.get_field_index(name))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column


class Scoring(Protocol):
    """What a scan asks of a scoring: the item columns it reads, and a scorer for a block of queries."""

    def columns(self) -> list[str]: ...

    def bind(self, queries: pa.Table): ...


class RunningTopK:
    """The k best items per query so far, by rounded score, then by id."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.rounded = np.full((n_queries, k), -np.inf)
        self.score = np.full((n_queries, k), -np.inf)
        self.item = np.full((n_queries, k), np.iinfo(np.int64).max)
        self.eligible = np.zeros(n_queries, np.int64)
        self.waiting: list[tuple[np.ndarray, ...]] = []  # found, but not yet in the lists

    def push(self, ids: np.ndarray, scores: np.ndarray | _Near | NearCosines) -> None:
        if isinstance(scores, _Near):
            self._push_near(ids, scores)
            return
        if isinstance(scores, NearCosines):
            self._push_cosines(ids, scores)
            return
        self.eligible += (scores > NOT_ELIGIBLE).sum(axis=0)
        last, last_id = self.rounded[:, -1], self.item[:, -1]
        # Only these need rounding; the least number rules out what is not eligible.
        rows, queries = np.nonzero(scores >= np.maximum(last - 10.0**-RANK_DIGITS, np.finfo(float).min))
        self._enter(ids[rows], queries, scores[rows, queries])

    def _push_near(self, ids: np.ndarray, near: _Near) -> None:
        """The same from scores that are off by a known share: only what may enter a list is scored exactly."""
        scores, share = near.scores, near.share
        n, n_queries = scores.shape
        self.eligible += n
        last, last_id, first_id = self.rounded[:, -1], self.item[:, -1], ids.min(initial=np.iinfo(np.int64).max)

        def chosen(last: np.ndarray, last_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if share:
                least = _below((last - 10.0**-RANK_DIGITS) * (1 - share))
            else:
                # A tie gets in by a smaller id only.
                least = np.where(last_id < first_id, last + 0.5, last).astype(np.float32)
            return np.divmod(np.flatnonzero(scores >= least), n_queries)

        rows, queries = chosen(last, last_id)
        if n >= self.k and self._surplus(queries) > n * n_queries // (256 if share else 16):
            # k of these items score at least so much, whatever else was seen.
            own = np.partition(scores, n - self.k, axis=0)[n - self.k] / (1 + share)
            last, last_id = np.maximum(last, own), np.where(own >= last, np.iinfo(np.int64).max, last_id)
            rows, queries = chosen(last, last_id)
        some = scores[rows, queries] > 0
        open_tie = some | (last[queries] < 0) | (ids[rows] <= last_id[queries])
        rows, queries, some = rows[open_tie], queries[open_tie], some[open_tie]
        exact = np.zeros(len(rows))
        exact[some] = near.exact(rows[some], queries[some])
        self._enter(ids[rows], queries, exact)

    def _surplus(self, queries: np.ndarray) -> int:
        """How many pairs there are beyond k of a query; where it pays, they are ruled out before more is done."""
        return int(np.maximum(0, np.bincount(queries, minlength=1) - self.k).sum())

    def _push_cosines(self, ids: np.ndarray, near: NearCosines) -> None:
        """The same from cosines that are off by a known number."""
        asking, (n, n_queries) = near.asking, near.cosine.shape
        self.eligible[asking] += near.eligible()
        last, last_id = self.rounded[asking, -1], self.item[asking, -1]
        rows, queries, scores = near.above(last, last_id, ids)
        if n >= self.k and self._surplus(queries) > n * n_queries // 16:
            # k of these items score at least so much, whatever else was seen.
            sure = near.sure(rows, queries, scores)
            every = np.full((n, n_queries), -np.inf, np.float32)
            every[rows[sure], queries[sure]] = scores[sure]
            last = np.maximum(last, np.partition(every, n - self.k, axis=0)[n - self.k] - near.off)
            enter = scores >= (last - 10.0**-RANK_DIGITS - near.off)[queries]
            rows, queries = rows[enter], queries[enter]
        exact = near.exact(rows, queries)
        some = exact > NOT_ELIGIBLE
        rows, queries, exact = rows[some], queries[some], exact[some]
        self._enter(ids[rows], queries if isinstance(asking, slice) else asking[queries], exact)

    def _enter(self, ids: np.ndarray, queries: np.ndarray, scores: np.ndarray) -> None:
        """Put some items into the lists of some queries, one score per pair; a few wait until there are more."""
        found = ids, queries, scores, np.round(scores, RANK_DIGITS)
        self.waiting.append(tuple(column[self._better(*found)] for column in found))
        if sum(len(w[0]) for w in self.waiting) >= self.rounded.size:
            self._merge()

    def _better(self, ids: np.ndarray, queries: np.ndarray, scores: np.ndarray, rounded: np.ndarray) -> np.ndarray:
        bar = self.rounded[queries, -1]
        return (rounded > bar) | ((rounded == bar) & (ids < self.item[queries, -1]))

    def _merge(self) -> None:
        if not self.waiting:
            return
        ids, queries, scores, rounded = map(np.concatenate, zip(*self.waiting, strict=True))
        self.waiting = []
        if not len(ids):
            return
        touched = np.unique(queries)
        q = np.concatenate([np.repeat(touched, self.k), queries])
        r = np.concatenate([self.rounded[touched].ravel(), rounded])
        s = np.concatenate([self.score[touched].ravel(), scores])
        i = np.concatenate([self.item[touched].ravel(), ids])
        order = np.lexsort((i, -r, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        keep = place < self.k
        order, at = order[keep], (q[keep], place[keep])
        self.rounded[at], self.score[at], self.item[at] = r[order], s[order], i[order]

    def rows(self, query_ids: np.ndarray, kind: int) -> pa.RecordBatch:
        """Entries found; the best entry of a query carries the number of eligible items."""
        self._merge()
        q, place = np.nonzero(self.score > NOT_ELIGIBLE)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids[q], pa.int64()),
                pa.array(np.full(len(q), kind), pa.int32()),
                pa.array(self.item[q, place], pa.int64()),
                pa.array(self.score[q, place], pa.float64()),
                pa.array(np.where(place == 0, self.eligible[q], 0), pa.int64()),
            ],
            names=["query_id", "kind", "item_id", "score", "eligible"],
        )


def rank_batches(batches: Iterator[pa.RecordBatch], scorer, k: int) -> Iterator[pa.RecordBatch]:
    """Score all batches and give the partial top-k of each list once at the end."""
    if not len(scorer.query_ids):
        return
    tops: dict[int, RunningTopK] = {}
    for batch in batches:
        ids = _column(batch, "item_id").to_numpy()
        # A short first run sets the bar that prunes the longer ones; scores in single precision bring their own.
        start, most = 0, max(1, min(_ROWS, _CELLS // scorer.width()))
        if getattr(scorer, "near", False):
            for start in range(0, len(ids), _ROWS):
                for kind, rows, near in scorer.parts(batch.slice(start, _ROWS)):
                    if kind not in tops:
                        tops[kind] = RunningTopK(len(scorer.query_ids), k)
                    if kind == FALLBACK and near.close(tops[MAIN].eligible >= k):
                        continue
                    tops[kind].push(ids[start + rows], near)
            continue
        rows = 4 * k
        while start < len(ids):
            take = min(rows, most)
            part = batch.slice(start, take)
            for kind, scores in scorer.score(part).items():
                if kind not in tops:
                    tops[kind] = RunningTopK(len(scorer.query_ids), k)
                tops[kind].push(ids[start : start + take], scores)
            start, rows = start + take, rows * 4
    for kind, top in tops.items():
        yield top.rows(scorer.query_ids, kind)


@dataclass(frozen=True)
class SparseScoring:
    """Dot product of sparse vectors: columns ``features`` and, if weighted, ``weights``."""

    weighted: bool = True

    def columns(self) -> list[str]:
        return ["features", "weights"] if self.weighted else ["features"]

    def bind(self, queries: pa.Table) -> _SparseScorer:
        return _SparseScorer(self, queries)


class _SparseScorer:
    positive = False  # whether items bring only weights that are not negative

    def __init__(self, spec: SparseScoring, queries: pa.Table) -> None:
        self.spec = spec
        self.query_ids = _column(queries, "query_id").to_numpy()
        lists = _column(queries, "features")
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.lookup = Lookup(self.vocabulary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lists)), _lengths(lists))
        weights = _numbers(_column(queries, "weights").flatten()) if spec.weighted else np.ones(len(flat))
        lengths = _lengths(lists)
        # Every term of a sum is rounded a few times; the terms are not negative, so the sum is off by no larger a share.
        longest = int(lengths.max(initial=0))
        self.share = (longest + 8) * 2.0**-23 if spec.weighted else 0.0
        near = len(self.query_ids) >= _NEAR_QUERIES and longest < 500_000
        self.near = near and (self.positive or not spec.weighted) and _single(weights)
        if self.near:
            self.groups = _Groups(owner, codes, weights, lengths, len(self.vocabulary))
            self.dense = self.groups.dense
            self.query_ids = self.query_ids[self.groups.order]
            self.query_codes, self.query_weights, self.query_lengths = codes, weights, lengths[self.groups.order]
            self.query_starts = (np.cumsum(lengths) - lengths)[self.groups.order]
            return
        order = np.argsort(codes, kind="stable")
        self.owner, self.weight = owner[order], weights[order]
        self.start = np.searchsorted(codes[order], np.arange(len(self.vocabulary) + 1))
        self._split_features()

    def width(self) -> int:
        """Numbers kept for an item while it is scored."""
        return len(self.query_ids) + len(self.dense)

    def score(self, batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        return {MAIN: self._products(batch.num_rows, self._entries(batch))}

    def _entries(self, batch: pa.RecordBatch):
        """(row, feature code, weight) of what the items share with any query."""
        lists = _column(batch, "features")
        row = np.repeat(np.arange(batch.num_rows), _lengths(lists))
        coded = lists.flatten().dictionary_encode()
        found = self.lookup.places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        hit = found >= 0
        code = found[hit]
        weight = np.ones(len(code))
        if self.spec.weighted:
            weight = _numbers(_column(batch, "weights").flatten())[hit]
        yield row[hit], code, weight

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, _Near]]:
        """Rows of like items and their scores in single precision, at most ``_NEAR_CELLS`` of them at a time."""
        entries = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), *self._entries(batch)]
        row, code, weight = map(np.concatenate, zip(*entries, strict=True))
        order = np.argsort(row.astype(np.uint16), kind="stable")  # a batch has fewer rows, and short numbers sort faster
        row, code, weight = row[order], code[order], weight[order]
        rows = self.groups.alike(batch.num_rows, row, code)
        starts = np.searchsorted(row, np.arange(batch.num_rows + 1))
        most = max(1, _NEAR_CELLS // len(self.query_ids))
        for at in range(0, len(rows), most):
            some = rows[at : at + most]
            size = starts[some + 1] - starts[some]
            ends = np.cumsum(size)
            mine = np.arange(size.sum()) + np.repeat(starts[some] - (ends - size), size)
            yield MAIN, some, _Near(self, np.append(0, ends), code[mine], weight[mine])

    def _products(self, n: int, entries) -> np.ndarray:
        """Sum of weight x query weight over (row, feature code, weight) entries.

        Features that many queries share go through one dense matrix product, the rest
        through their query lists.
        """
        n_queries = len(self.query_ids)
        total = np.zeros(n * n_queries)
        dense = np.zeros((n, len(self.dense)), self.dense.dtype)
        for row, code, weight in entries:
            column = self.dense_column[code]
            often = column >= 0
            np.add.at(dense.ravel(), row[often] * len(self.dense) + column[often], weight[often])
            row, code, weight = row[~often], code[~often], weight[~often]
            first = self.start[code]
            width = self.start[code + 1] - first
            ends, done = np.cumsum(width), 0
            while done < len(row):
                # One feature is in at most n_queries queries, so a run stays bounded.
                base = ends[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(ends, base + _CELLS, side="right")))
                w = width[done:stop]
                at = np.repeat(first[done:stop] - (ends[done:stop] - w - base), w) + np.arange(w.sum())
                cell = np.repeat(row[done:stop] * n_queries, w) + self.owner[at]
                value = np.repeat(weight[done:stop], w) * self.weight[at]
                np.add.at(total, cell, value)
                done = stop
        return total.reshape(n, n_queries) + dense @ self.dense

    def _split_features(self) -> None:
        """Choose the features of the dense product, at most ``_DENSE_CELLS`` weights in all."""
        n_queries, width = len(self.query_ids), np.diff(self.start)
        often = np.flatnonzero(width >= max(8, n_queries // 32))
        most = _DENSE_CELLS // max(1, n_queries)
        often = often[np.argsort(-width[often], kind="stable")][:most]
        self.dense_column = np.full(len(width), -1)
        self.dense_column[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n_queries))
        for column, feature in enumerate(often):
            part = slice(self.start[feature], self.start[feature + 1])
            np.add.at(self.dense[column], self.owner[part], self.weight[part])


class _Groups:
    """Queries of a block by groups that are alike; single precision.

    A feature that many queries of a group share goes through the group's own dense product, so that texts of another kind,
    such as another language, do not widen it. All other entries are lists of queries by feature.
    """

    def __init__(self, owner: np.ndarray, codes: np.ndarray, weights: np.ndarray, lengths: np.ndarray, n_codes: int) -> None:
        n, count = len(lengths), np.bincount(codes, minlength=n_codes)
        self.room = np.empty((0, n), np.float32)
        most = _NEAR_DENSE_CELLS // max(1, n)
        top = np.argsort(-count, kind="stable")[: 4 * most]
        self.column = np.full(n_codes, -1)  # of features that may be dense in a group
        self.column[top] = np.arange(len(top))
        kinds = max(1, min(8, n // (2 * _NEAR_GROUP)))
        self.centres = np.zeros((1, len(top)), np.float32)
        kind = np.zeros(n, np.int64)
        if kinds > 1 and len(top):
            kind = self._kinds(owner, codes, lengths, kinds)
        self.order = np.lexsort((lengths, kind))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        owner = place[owner]
        cuts = np.searchsorted(kind[self.order], np.arange(len(self.centres) + 1))
        halves = [(a, (a + b) // 2, b) if b - a >= 2 * _NEAR_GROUP else (a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        edges = np.unique(np.concatenate([np.array(h) for h in halves]))
        self.slices = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        group = np.searchsorted(edges, owner, side="right") - 1
        # Counted by group and feature; what is dense leaves the lists.
        column = self.column[codes]
        known = column >= 0
        shared = np.bincount(group[known] * len(top) + column[known], minlength=len(self.slices) * len(top))
        shared = shared.reshape(len(self.slices), len(top))
        size = np.array([[s.stop - s.start] for s in self.slices])
        rank = np.argsort(np.argsort(-shared, axis=1, kind="stable"), axis=1)
        often = (shared >= np.maximum(8, size // _NEAR_OFTEN)) & (rank < most)
        self.columns = [np.flatnonzero(o) for o in often]
        cells = [len(c) * (s.stop - s.start) for c, s in zip(self.columns, self.slices, strict=True)]
        ends = np.cumsum([0, *cells])
        self.dense = np.zeros(ends[-1], np.float32)
        dense = np.zeros(len(codes), bool)
        dense[known] = often[group[known], column[known]]
        at = np.cumsum(often, axis=1) - 1
        g, c = group[dense], column[dense]
        first = np.array([s.start for s in self.slices], np.int64)
        np.add.at(self.dense, ends[g] + at[g, c] * size[g, 0] + owner[dense] - first[g], weights[dense].astype(np.float32))
        self.products = [self.dense[ends[i] : ends[i + 1]].reshape(len(c), size[i, 0]) for i, c in enumerate(self.columns)]
        order = np.lexsort((owner[~dense], codes[~dense]))
        self.lists = np.empty(len(order), [("owner", np.int32), ("weight", np.float32)])  # of queries, by feature
        self.lists["owner"], self.lists["weight"] = owner[~dense][order], weights[~dense][order]
        self.start = np.searchsorted(codes[~dense][order], np.arange(n_codes + 1))

    def _kinds(self, owner: np.ndarray, codes: np.ndarray, lengths: np.ndarray, kinds: int) -> np.ndarray:
        """A kind for every query, by the frequent features it holds: a few rounds of means."""
        width = min(_NEAR_MARKS, int(self.column.max()) + 1)
        column = self.column[codes]
        known = (column >= 0) & (column < width)
        sign = np.zeros((len(lengths), width), np.float32)
        sign[owner[known], column[known]] = 1.0
        sign /= np.sqrt(np.maximum(1.0, sign.sum(axis=1)))[:, None]
        self.centres = sign[np.linspace(0, len(sign) - 1, kinds).astype(int)]
        for _ in range(6):
            kind = (sign @ self.centres.T).argmax(axis=1)
            means = [sign[kind == i].mean(axis=0) if (kind == i).any() else self.centres[i] for i in range(kinds)]
            self.centres = np.array([m / max(1e-9, float(np.sqrt(m @ m))) for m in means], np.float32)
        return (sign @ self.centres.T).argmax(axis=1)

    def alike(self, n: int, row: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Item rows, those of one kind side by side, short ones first."""
        if len(self.centres) == 1:
            return np.arange(n)
        column = self.column[code]
        known = (column >= 0) & (column < self.centres.shape[1])
        held = np.zeros((n, self.centres.shape[1]), np.float32)
        held[row[known], column[known]] = 1.0
        return np.lexsort((np.bincount(row, minlength=n), (held @ self.centres.T).argmax(axis=1)))

    def scores(self, starts: np.ndarray, code: np.ndarray, weight: np.ndarray, n_queries: int) -> np.ndarray:
        """Sums of products for items whose entries lie one after the other."""
        n, weight = len(starts) - 1, weight.astype(np.float32)
        row, column = np.repeat(np.arange(n), np.diff(starts)), self.column[code]
        known = column >= 0
        here, place = np.unique(column[known], return_inverse=True)
        items = np.zeros((n, len(here)), np.float32)
        np.add.at(items.ravel(), row[known] * len(here) + place, weight[known])
        if len(self.room) < n:
            self.room = np.empty((n, n_queries), np.float32)
        out = self.room[:n]  # used again by the next step: fresh pages are dear
        for some, columns, product in zip(self.slices, self.columns, self.products, strict=True):
            at = np.searchsorted(here, columns)
            held = np.flatnonzero(here[np.minimum(at, len(here) - 1)] == columns) if len(here) else at[:0]
            if len(held) < len(columns):
                product = product[held]
            np.matmul(items[:, at[held]], product, out=out[:, some])
        first = self.start[code]
        width = self.start[code + 1] - first
        for i in range(n):
            mine = slice(starts[i], starts[i + 1])
            size = width[mine]
            ends = np.cumsum(size)
            if len(ends) and ends[-1]:
                at = np.arange(ends[-1])
                at += np.repeat(first[mine] - (ends - size), size)
                lists = self.lists[at]
                np.add.at(out[i], lists["owner"].astype(np.intp), lists["weight"] * np.repeat(weight[mine], size))
        return out


class _Near:
    """Sums of products of weights that are not negative, in single precision: off by at most ``share`` of themselves."""

    def __init__(self, scorer: _SparseScorer, starts: np.ndarray, code: np.ndarray, weight: np.ndarray) -> None:
        self.scorer, self.share = scorer, scorer.share
        self.starts, self.code, self.weight = starts, code, weight
        self.scores = scorer.groups.scores(starts, code, weight, len(scorer.query_ids))

    def exact(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Scores of some pairs in double precision; ``rows`` ascend."""
        if not self.share:  # whole numbers
            return self.scores[rows, queries].astype(float)
        item, out = np.zeros(len(self.scorer.vocabulary)), np.empty(len(rows))
        ends = np.append(np.flatnonzero(rows[1:] != rows[:-1]) + 1, len(rows)) if len(rows) else []
        codes, weights = self.scorer.query_codes, self.scorer.query_weights
        first = 0
        for end in ends:
            mine = slice(self.starts[rows[first]], self.starts[rows[first] + 1])
            code = self.code[mine]
            np.add.at(item, code, self.weight[mine])
            starts, lengths = self.scorer.query_starts[queries[first:end]], self.scorer.query_lengths[queries[first:end]]
            ranges = [slice(a, a + n) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
            value = item[np.concatenate([codes[r] for r in ranges])]
            value *= np.concatenate([weights[r] for r in ranges])
            # A sum of its own for every query; one without features has none.
            some, sums = lengths > 0, np.zeros(len(lengths))
            if some.any():
                sums[some] = np.add.reduceat(value, (np.cumsum(lengths) - lengths)[some])
            out[first:end] = sums
            item[code] = 0.0
            first = end
        return out


def _single(weights: np.ndarray) -> bool:
    """Whether products of these and their sums stay far from the ends of single precision; none is negative or NaN."""
    return bool(((weights == 0) | ((weights >= 1e-12) & (weights <= 1e12))).all())


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class TextScoring:
    """Sparse dot product whose item side is counted from the text as it streams by.

    Items bring the units of both blocks (``word``, ``char``) and one factor per block
    (``word_scale``, ``char_scale``). Only n-grams that some query holds are ever looked
    at, so nothing as large as an item vector is stored or moved.
    """

    word_sizes: tuple[int, int]
    char_sizes: tuple[int, int]
    weighted: bool = True

    def columns(self) -> list[str]:
        return ["word", "char", "word_scale", "char_scale"]

    def bind(self, queries: pa.Table) -> _TextScorer:
        return _TextScorer(self, queries)


class _TextScorer(_SparseScorer):
    """Query features are n-grams with the letter of their block in front."""

    positive = True

    def __init__(self, spec: TextScoring, queries: pa.Table) -> None:
        super().__init__(spec, queries)
        names = self.vocabulary.cast(pa.string())
        self.blocks = []
        for letter, kind, sizes, count in (
            ("w", "word", spec.word_sizes, word_ngrams),
            ("c", "char", spec.char_sizes, char_ngrams),
        ):
            mine = pc.starts_with(names, letter)
            codes = np.flatnonzero(mine.to_numpy(zero_copy_only=False))
            terms = pc.utf8_slice_codeunits(names.filter(mine), 1)
            self.blocks.append((kind, sizes, count, Lookup(terms), codes))

    def _entries(self, batch: pa.RecordBatch):
        for kind, sizes, count, terms, codes in self.blocks:
            if not len(codes):
                continue
            scale = _numbers(_column(batch, f"{kind}_scale"))
            for c in count(_column(batch, kind), *sizes):
                place = terms.places(c.terms)[c.gram]
                hit = place >= 0
                yield c.row[hit], codes[place[hit]], c.tf[hit] * scale[c.row[hit]]


@dataclass(frozen=True)
class DenseScoring:
    """Cosine similarity of ``embedding``.

    demote        similarity above this becomes -1 (kept, ranked last)
    band          closed similarity interval; with it two lists are made, the blended
                  scores inside the band and the plain similarity of everything
    facets        (item column, query column) pairs compared inside the band
    weight        share of the similarity in the blended score
    limits        only items inside a query's own limits are eligible
    """

    demote: float | None = None
    band: tuple[float, float] | None = None
    facets: tuple[tuple[str, str], ...] = ()
    weight: float = 1.0
    limits: QueryLimits | None = None

    def columns(self) -> list[str]:
        limited = self.limits.item_columns() if self.limits else []
        return ["embedding", *dict.fromkeys([*(f for f, _ in self.facets), *limited])]

    def bind(self, queries: pa.Table) -> _DenseScorer:
        return _DenseScorer(self, queries)


class _DenseScorer:
    def __init__(self, spec: DenseScoring, queries: pa.Table) -> None:
        self.spec = spec
        self.query_ids = _column(queries, "query_id").to_numpy()
        q = vector_matrix(_column(queries, "embedding"))
        self.dim = q.shape[1]
        self.unit = q / self._safe(np.sqrt((q * q).sum(axis=1)))[:, None]
        self.facets = [(item, _column(queries, query)) for item, query in spec.facets]
        self.inside = spec.limits.bind(queries) if spec.limits else None
        self.near = len(self.query_ids) >= _NEAR_QUERIES and not np.isnan(self.unit).any()
        if self.near:
            self.single = self.unit.T.astype(np.float32)
            self.off = cosine_error(self.unit)
            self.room = Room(_COSINE_CELLS // len(self.query_ids), len(self.query_ids))

    def width(self) -> int:
        return len(self.query_ids)

    @staticmethod
    def _safe(norms: np.ndarray) -> np.ndarray:
        return np.where(norms == 0, 1.0, norms)

    def _units(self, batch: pa.RecordBatch) -> np.ndarray:
        x = vector_matrix(_column(batch, "embedding"), self.dim)
        return x / self._safe(np.sqrt((x * x).sum(axis=1)))[:, None]

    def matches(self, batch: pa.RecordBatch, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Number of equal facets of some pairs."""
        out = np.zeros(len(rows))
        for name, wanted in self.facets:
            have = _column(batch, name)
            if pa.types.is_string(have.type) or pa.types.is_large_string(have.type):
                values = pc.unique(wanted).drop_null()
                a = pc.fill_null(pc.index_in(have, value_set=values), -1)
                b = pc.fill_null(pc.index_in(wanted, value_set=values), -2)
                a, b = a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)
            else:
                a, b = _numbers(have), _numbers(wanted)  # NULL is NaN and equals nothing
            out += a[rows] == b[queries]
        return out

    def blended(self, batch: pa.RecordBatch, rows: np.ndarray, queries: np.ndarray, similarity: np.ndarray) -> np.ndarray:
        """Scores of some pairs whose similarity is inside the band."""
        out = self.spec.weight * similarity
        if self.facets:
            out += (1.0 - self.spec.weight) * self.matches(batch, rows, queries) / len(self.facets)
        return out

    def score(self, batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        similarity = self._units(batch) @ self.unit.T
        if self.spec.band is not None:
            low, high = self.spec.band
            rows, queries = np.nonzero((similarity >= low) & (similarity <= high))
            score = np.full(similarity.shape, NOT_ELIGIBLE)
            score[rows, queries] = self.blended(batch, rows, queries, similarity[rows, queries])
            return {MAIN: score, FALLBACK: similarity}
        if self.spec.demote is not None:
            similarity[similarity > self.spec.demote] = -1.0
        if self.inside is not None:
            similarity[~self.inside(batch)] = NOT_ELIGIBLE
        return {MAIN: similarity}

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, NearCosines]]:
        """Cosines in single precision, at most ``_COSINE_CELLS`` of them at a time."""
        units, most = self._units(batch), len(self.room.cosine)
        for at in range(0, len(units), most):
            some, rows = units[at : at + most], np.arange(at, min(at + most, len(units)))
            cosine = np.matmul(some.astype(np.float32), self.single, out=self.room.cosine[: len(some)])
            part = batch.slice(at, most)
            if self.spec.band is None:
                allowed = self.inside(part) if self.inside is not None else None
                yield MAIN, rows, NearCosines(cosine, self.off, some, self.unit, self.room, self.spec.demote, allowed)
                continue
            yield MAIN, rows, _NearBlended(cosine, self.off, some, self.unit, self.room, self, part)
            yield FALLBACK, rows, NearCosines(cosine, self.off, some, self.unit, self.room)


class Room:
    """Memory for a step, used again by the next one: fresh pages cost as much as the product."""

    def __init__(self, rows: int, columns: int) -> None:
        self.cosine = np.empty((max(1, rows), columns), np.float32)
        self.masks = [np.empty(self.cosine.shape, bool) for _ in range(4)]

    def mask(self, i: int, like: np.ndarray) -> np.ndarray:
        """The i-th mask, as large as the cosines of a step."""
        return self.masks[i].ravel()[: like.size].reshape(like.shape)


def cosine_error(units: np.ndarray) -> np.ndarray:
    """How far a cosine of each of these unit vectors and another one is off in single precision; of zeros it is not."""
    # Two roundings of the factors, one of each product and one of each sum, each 2^-24 of terms whose sizes sum up to 1 at most.
    return np.where((units != 0).any(axis=1), (units.shape[1] + 8) * 2.0**-23, 0.0)


def column_counts(mask: np.ndarray) -> np.ndarray:
    """How many rows hold in each column; in bytes first, as that is much faster."""
    out = np.zeros(mask.shape[1], np.int64)
    for at in range(0, len(mask), 255):
        out += np.add.reduce(mask[at : at + 255].view(np.uint8), axis=0, dtype=np.uint8)
    return out


class NearCosines:
    """Cosines of items and queries in single precision, off by at most ``off`` of the query.

    queries    unit vectors of the whole block
    demote     similarity above this becomes -1
    allowed    which pairs count at all
    asking     places of the queries in their block
    least      pairs with a lower score need not be given, per query
    """

    def __init__(self, cosine: np.ndarray, off: np.ndarray, items: np.ndarray, queries: np.ndarray, room: Room, demote: float | None = None,
                 allowed: np.ndarray | None = None, asking: np.ndarray | slice = slice(None), least: np.ndarray | None = None) -> None:
        self.cosine, self.off, self.items, self.queries, self.room = cosine, off, items, queries, room
        self.demote, self.allowed, self.asking, self.least = demote, allowed, asking, least

    def eligible(self) -> np.ndarray | int:
        return len(self.cosine) if self.allowed is None else column_counts(self.allowed)

    def close(self, queries: np.ndarray) -> bool:
        """Nothing is to be given for these queries any more; whether that are all."""
        self.least = np.where(queries, 2.0, -np.inf)
        return bool(queries.all())

    def _chosen(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(np.flatnonzero(chosen), self.cosine.shape[1])

    def above(self, last: np.ndarray, last_id: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that may enter lists which end with these scores and ids, and their scores, demoted but not exact."""
        if self.least is not None:
            last = np.maximum(last, self.least)
        bar = last - 10.0**-RANK_DIGITS - self.off
        # All cosines of a query of zeros tie, and a tie gets in by a smaller id only.
        full = (self.off == 0) & (last >= 0) & (last_id < ids.min(initial=np.iinfo(np.int64).max))
        chosen = np.greater_equal(self.cosine, _below(np.where(full, 2.0, bar)), out=self.room.mask(0, self.cosine))
        if self.allowed is not None:
            chosen &= self.allowed
        rows, queries = self._chosen(chosen)
        scores = self.cosine[rows, queries]
        if self.demote is not None:
            scores[scores > self.demote + self.off[queries]] = -1.0
        keep = (scores >= bar[queries]) & ((self.off[queries] > 0) | (scores > last[queries]) | (ids[rows] <= last_id[queries]))
        return rows[keep], queries[keep], scores[keep]

    def sure(self, rows: np.ndarray, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Which of these scores are theirs within ``off``, whatever single precision leaves open."""
        if self.demote is None:
            return np.ones(len(rows), bool)
        return (scores < self.demote - self.off[queries]) | (self.cosine[rows, queries] > self.demote + self.off[queries])

    def similarity(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Cosines of some pairs in double precision."""
        out = np.empty(len(rows))
        queries = queries if isinstance(self.asking, slice) else self.asking[queries]
        for at in range(0, len(rows), _EXACT_PAIRS):
            some = slice(at, at + _EXACT_PAIRS)
            out[some] = np.einsum("ij,ij->i", self.items[rows[some]], self.queries[queries[some]])
        return out

    def exact(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        out = self.similarity(rows, queries)
        if self.demote is not None:
            out[out > self.demote] = -1.0
        return out


class _NearBlended(NearCosines):
    """Scores inside a band of similarity: what single precision leaves open at its ends is looked at again."""

    def __init__(self, cosine: np.ndarray, off: np.ndarray, items: np.ndarray, queries: np.ndarray, room: Room, scorer: _DenseScorer, batch: pa.RecordBatch) -> None:
        super().__init__(cosine, off * max(1.0, abs(scorer.spec.weight)), items, queries, room)
        self.scorer, self.batch, (self.low, self.high) = scorer, batch, scorer.spec.band
        self.allowed, self.inner, other = (room.mask(i, cosine) for i in (1, 2, 0))
        np.greater_equal(cosine, _below(self.low - off), out=self.allowed)
        self.allowed &= np.less_equal(cosine, -_below(-self.high - off), out=other)
        np.greater(cosine, -_below(-self.low - off), out=self.inner)
        self.inner &= np.less(cosine, _below(self.high - off), out=other)

    def eligible(self) -> np.ndarray:
        out = column_counts(self.inner)
        rows, queries = self._chosen(np.logical_xor(self.allowed, self.inner, out=self.room.mask(0, self.cosine)))
        exact = self.similarity(rows, queries)
        return out + np.bincount(queries[(exact >= self.low) & (exact <= self.high)], minlength=len(out))

    def above(self, last: np.ndarray, last_id: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        weight, facets = self.scorer.spec.weight, 1.0 - self.scorer.spec.weight if self.scorer.facets else 0.0
        bar = last - 10.0**-RANK_DIGITS - self.off
        chosen = self.allowed
        if weight > 0 and facets >= 0:
            # With every facet equal, a similarity of so much is needed.
            chosen = np.greater_equal(self.cosine, _below((bar - facets) / weight - self.off), out=self.room.mask(0, self.cosine))
            chosen &= self.allowed
        rows, queries = self._chosen(chosen)
        scores = self.scorer.blended(self.batch, rows, queries, self.cosine[rows, queries].astype(float))
        keep = scores >= bar[queries]
        return rows[keep], queries[keep], scores[keep]

    def sure(self, rows: np.ndarray, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return self.inner[rows, queries]

    def exact(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        similarity = self.similarity(rows, queries)
        blended = self.scorer.blended(self.batch, rows, queries, similarity)
        return np.where((similarity >= self.low) & (similarity <= self.high), blended, NOT_ELIGIBLE)


def _below(values: np.ndarray) -> np.ndarray:
    """The next smaller numbers in single precision."""
    return np.nextafter(np.asarray(values).astype(np.float32), np.float32(-np.inf))

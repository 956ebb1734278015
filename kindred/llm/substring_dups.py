"""Repeated passages of words, found by doubling the length of a window; the first occurrence of each stays.

A window is a number of consecutive words of one document. It goes if the same words also start earlier, in
a document of a smaller id or before it in its own; every word that such a window covers is removed. All
windows are judged on the input.

1. Rows with the same text form one class; its smallest id speaks for it. The other rows of the class repeat
   it from their first word to the last, so they need no windows.
2. Half a window is the first length. Of the half windows inside each window the one with the smallest hash is
   its anchor: equal windows have equal anchors, and one place in six is an anchor. Anchors are counted by
   one shuffle, with partial sums; only those that occur again survive.
3. Windows whose anchor survived are extended to twice the length, the whole window, by joining the hashes of
   their halves (128 bits). The smallest document of each window is found by one shuffle, with partial minima.
   A document then gets the windows that are its own back; every other survivor of it is a repetition.
4. :func:`extended` goes on from there: windows that occur again are doubled until none does.

Texts are read in place; only those with surviving anchors are shuffled. Rows that no join can need are
dropped before the shuffles by a bitmap of fixed size.

Defined cases: a NULL text or one without words has no windows and keeps nothing, a text shorter than a
window keeps all its words. Rows without an id come after all others; rows with one id and different texts
are ordered by a hash of the text, and repeated rows are one document, so they have the same result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.bitmaps import bitmap, only_marked
from kindred.shared import scratch, stored

WINDOW = 20
PIECE = 1 << 19  # words handled at a time; a longer document is a piece of its own

_random = np.random.default_rng(20250911)
_KEYS = _random.integers(0, 1 << 63, (2, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SAME_ROW = ("_key", "_h1", "_h2")


class _WordHashes(dict):
    """Hash of a word, remembered for the words of a task; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray, keys: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * keys[4]
    x = (x ^ (x >> np.uint64(29))) * keys[5]
    return x ^ (x >> np.uint64(32))


def doubled(h: np.ndarray, length: int, keys: np.ndarray) -> np.ndarray:
    """Hash of the window of twice the ``length`` at each place, from the hashes of its two halves."""
    first, second = h[: len(h) - length], h[length:]
    return _mix(first * keys[0] + ((second * keys[1]) ^ (second >> np.uint64(23))) * keys[2], keys)


def windows(h: np.ndarray, length: int, keys: np.ndarray) -> np.ndarray:
    """Hash of the window at each place, doubled up from the largest odd part of the length."""
    if len(h) < length:
        return h[:0]
    base = length // (length & -length)
    out = np.zeros(len(h) - base + 1, dtype=np.uint64)
    for k in range(base):
        out = out * keys[3] + h[k : len(h) - base + 1 + k]
    out = _mix(out, keys)
    while base < length:
        out = doubled(out, base, keys)
        base *= 2
    return out


def _running(h: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Smallest or largest value of every ``width`` places that follow each other."""
    done = 1
    while 2 * done <= width:
        h = pick(h[: len(h) - done], h[done:])
        done *= 2
    return pick(h[: len(h) - (width - done)], h[width - done :]) if width > done else h


class Piece:
    """The words of some documents end to end; no window reaches over the end of a document."""

    def __init__(self, bodies: list[list[bytes]], hashes: dict[bytes, int], window: int):
        self.sizes = np.array([len(b) for b in bodies])
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.h = np.fromiter((hashes[w] for b in bodies for w in b), dtype=np.uint64, count=int(self.ends[-1]) if len(bodies) else 0)
        self.window = window
        places = np.arange(max(0, len(self.h) - window + 1))
        self.owner = np.searchsorted(self.ends, places, side="right")
        self.inside = places + window <= self.ends[self.owner] if len(places) else np.zeros(0, dtype=bool)

    def half_windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all half windows, and for each window the smallest of those inside it."""
        half = windows(self.h, self.window // 2, _KEYS[0])
        return half, _running(half, self.window // 2 + 1, np.minimum) if len(self.inside) else half[:0]

    def anchors(self) -> list[np.ndarray]:
        """Per document the hashes of its anchors, one entry for each place."""
        half, least = self.half_windows()
        if not self.inside.any():
            return [half[:0]] * len(self.sizes)
        reach = self.window // 2
        around = np.concatenate((np.zeros(reach, np.uint64), np.where(self.inside, least, 0), np.zeros(reach, np.uint64)))
        # A half window is an anchor where it is the smallest of some window over it.
        chosen = np.flatnonzero(_running(around, reach + 1, np.maximum) == half)
        cut = np.searchsorted(chosen, self.starts), np.searchsorted(chosen, self.ends)
        return [half[chosen[a:b]] for a, b in zip(*cut, strict=True)]

    def survivors(self, repeated: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per document the places of windows whose anchor is in its list, and two hashes of each."""
        _, least = self.half_windows()
        one, two = (windows(self.h, self.window, k) for k in _KEYS)
        out = []
        for start, end, known in zip(self.starts, self.ends, repeated, strict=True):
            last = max(int(start), int(end) - self.window + 1)
            own = np.flatnonzero(np.isin(least[start:last], known))
            out.append((own, one[start + own], two[start + own]))
        return out


def _numbers(lists: pa.Array, i: int) -> np.ndarray:
    values = lists[i].values
    return np.zeros(0, np.uint64) if values is None else values.to_numpy(zero_copy_only=False).view(np.uint64)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """First row and words of so many texts that a piece of bounded size holds."""
    first, bodies, size = 0, [], 0
    for i, text in enumerate(texts):
        words = (text.as_py() or "").encode().split()
        if bodies and size + len(words) > PIECE:
            yield first, bodies
            first, bodies, size = i, [], 0
        bodies.append(words)
        size += len(words)
    if bodies:
        yield first, bodies


def _sketched(rows: DataFrame, window: int) -> DataFrame:
    """``_key, _h1, _h2, n, whole, anchors`` per row: number of words, digest of all words, anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for first, bodies in _pieces(batch.column("_text")):
                part = batch.slice(first, len(bodies))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in SAME_ROW] + [
                        pa.array([len(b) for b in bodies], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(b)).digest() for b in bodies], pa.binary()),
                        pa.array([a.view(np.int64) for a in Piece(bodies, hashes, window).anchors()], pa.list_(pa.int64())),
                    ], [*SAME_ROW, "n", "whole", "anchors"],
                )

    return rows.mapInArrow(run, f"{_row_type(rows)}, n long, whole binary, anchors array<long>")


def _row_type(rows: DataFrame) -> str:
    return f"_key {rows.schema['_key'].dataType.simpleString()}, _h1 long, _h2 long"


def _windows_of(texts: DataFrame, window: int, all_places: bool = False) -> DataFrame:
    """``h1, h2, rank, place``: the surviving windows of every text, each with its first place there, or with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            ranks = batch.column("rank").to_numpy()
            known = batch.column("repeated")
            for first, bodies in _pieces(batch.column("_text")):
                lists = [_numbers(known, first + i) for i in range(len(bodies))]
                found = Piece(bodies, hashes, window).survivors(lists)
                if not all_places:
                    once = [np.unique(one, return_index=True)[1] for _, one, _ in found]
                    found = [tuple(x[at] for x in f) for f, at in zip(found, once, strict=True)]
                owner = np.repeat(ranks[first : first + len(found)], [len(places) for places, *_ in found])
                places, one, two = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(owner), pa.array(places)], ["h1", "h2", "rank", "place"]
                )

    return texts.mapInArrow(run, "h1 long, h2 long, rank long, place long")


def covered(size: int, places: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` words the windows at some places cover."""
    steps = np.zeros(size + 1, dtype=np.int64)
    steps[places] += 1
    np.subtract.at(steps, places + window, 1)
    return np.cumsum(steps[:-1]) > 0


def _spans(gone: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """What is removed from every text: all survivors that are not its own, or stand in it before."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            known, owned = batch.column("repeated"), batch.column("owned")
            for first, bodies in _pieces(batch.column("_text")):
                lists = [_numbers(known, first + i) for i in range(len(bodies))]
                removed, digests, spans = [], [], []
                for i, (places, one, _) in enumerate(Piece(bodies, hashes, window).survivors(lists)):
                    own = _numbers(owned, first + i)
                    earliest = np.zeros(len(places), dtype=bool)
                    earliest[np.unique(one, return_index=True)[1]] = True
                    gone = covered(len(bodies[i]), places[~(earliest & np.isin(one, own))], window)
                    removed.append(int(gone.sum()))
                    spans.append(_spans(gone))
                    kept = [w for w, g in zip(bodies[i], gone.tolist(), strict=True) if not g]
                    digests.append(hashlib.sha256(b" ".join(kept)).digest())
                part = batch.slice(first, len(bodies))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in SAME_ROW]
                    + [pa.array(removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(spans, span)],
                    [*SAME_ROW, "removed", "rest", "spans"],
                )

    return texts.mapInArrow(run, f"{_row_type(texts)}, removed long, rest binary, spans array<struct<start:long,end:long>>")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    of_text = F.col(text)
    return docs.select(
        F.col(key).alias("_key"), F.xxhash64(of_text).alias("_h1"), F.xxhash64(F.lit(1), of_text).alias("_h2"), of_text.alias("_text")
    )


def _matched(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """``rows`` joined with the entries of ``other`` for the same id and text."""
    named = other.withColumnsRenamed({c: f"_of{c}" for c in SAME_ROW})
    same = F.col("_key").eqNullSafe(F.col("_of_key")) & (F.col("_h1") == F.col("_of_h1")) & (F.col("_h2") == F.col("_of_h2"))
    return rows.join(named, same, how).drop(*(f"_of{c}" for c in SAME_ROW))


def _with_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the texts of its rows; other texts are dropped before the shuffle."""
    return _matched(only_marked(rows, F.col("_h1"), bitmap(wanted, "_h1")), wanted, "inner")


def _leaders(sketches: DataFrame, window: int) -> DataFrame:
    """``_key, _h1, _h2, rank, anchors``: one row of every class of equal texts, ranked by id and then by text."""
    who = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"))
    classes = sketches.where(F.col("n") >= window).groupBy("_h1", "_h2").agg(F.min(who).alias("who"), F.first("anchors").alias("anchors"))
    # Numbers that rise with the order of a sorted table: no task sees the whole of it.
    ranked = classes.orderBy("who", "_h1", "_h2").withColumn("rank", F.monotonically_increasing_id())
    return ranked.select(F.col("who.key").alias("_key"), "_h1", "_h2", "rank", "anchors")


def _candidates(leaders: DataFrame) -> DataFrame:
    """``_key, _h1, _h2, rank, repeated``: leaders with an anchor that occurs again, and all such anchors."""
    placed = leaders.select("rank", F.explode("anchors").alias("anchor"))
    again = stored(placed.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "anchors")
    met = only_marked(placed, F.col("anchor"), bitmap(again, "anchor")).join(again, "anchor")
    lists = met.groupBy("rank").agg(F.collect_set("anchor").alias("repeated"))
    return leaders.drop("anchors").join(lists, "rank")


def _first_documents(texts: DataFrame, window: int) -> DataFrame:
    """``h1, h2, rank``: every surviving window with the smallest document that holds it."""
    return _windows_of(texts, window).groupBy("h1", "h2").agg(F.min("rank").alias("rank"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256, spans`` per row; spans are the removed words, from 0, end exclusive.

    ``window`` is an even number of words.
    """
    if window < 2 or window % 2:
        raise ValueError("a window is an even number of words")
    rows = _rows(docs, key, text)
    with scratch(docs.sparkSession) as keep:
        sketches = keep(_sketched(rows, window), "sketches")
        leaders = stored(_leaders(sketches, window), "leaders")
        wanted = stored(_candidates(leaders), "candidates")
        first = _first_documents(_with_texts(rows, wanted), window)
        owned = first.groupBy("rank").agg(F.collect_list("h1").alias("owned"))
        judged = stored(wanted.join(owned, "rank", "left").drop("rank"), "judged")
        cut = stored(_cut(_with_texts(rows, judged), window).dropDuplicates(list(SAME_ROW)), "cut")
        special = keep(_matched(leaders.select(*SAME_ROW, F.lit(True).alias("_leads")), cut, "left"), "special")
    found = _matched(sketches, special, "left")
    copied = F.col("_leads").isNull() & (F.col("n") >= window)
    return found.select(
        F.col("_key").alias(key), F.col("n").alias("n_words"),
        F.when(copied, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.sha2(F.lit(b""), 256)).otherwise(F.lower(F.hex(F.coalesce("rest", "whole")))).alias("kept_sha256"),
        F.when(copied, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))))
        .otherwise(F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"))).alias("spans"),
    )


def extended(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, length, n_windows``: for every length reached by doubling, how many windows of a text occur again.

    Only windows whose two halves occur again are tried at the next length; it ends when none is left. One row of
    every class of equal texts is reported, the one that speaks for it.
    """
    rows = _rows(docs, key, text)
    with scratch(docs.sparkSession) as keep:
        leaders = stored(_leaders(stored(_sketched(rows, window), "sketches"), window), "leaders")
        wanted = stored(_candidates(leaders), "candidates")
        texts = _with_texts(rows, wanted).dropDuplicates(list(SAME_ROW))
        tried, length, reached = _windows_of(texts, window, all_places=True), window, []
        while True:
            again = tried.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
            level = stored(tried.join(again, ["h1", "h2"]), "level")
            if level.isEmpty():
                break
            reached.append(level.groupBy("rank").agg(F.lit(length).cast("long").alias("length"), F.count("*").alias("n_windows")))
            first, second = level.alias("first"), level.alias("second")
            both = first.join(second, (F.col("first.rank") == F.col("second.rank")) & (F.col("first.place") + length == F.col("second.place")))
            halves = [F.col("first.h1"), F.col("first.h2"), F.col("second.h1"), F.col("second.h2")]
            tried = both.select(
                F.xxhash64(*halves).alias("h1"), F.xxhash64(F.lit(1), *halves).alias("h2"), F.col("first.rank").alias("rank"),
                F.col("first.place").alias("place"),
            )
            length *= 2
        none = level.select("rank", F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("n_windows"))
        for part in reached:
            none = none.union(part)
        return keep(none.join(wanted.select("rank", F.col("_key").alias(key)), "rank").select(key, "length", "n_windows"), "extended")

"""Near-duplicate groups by min-max hashing, every link confirmed on the full shingle sets.

A document is the set of its distinct 3-word shingles. Under each of 60 permutations both the smallest
and the largest value are kept: two estimates of similarity for one hash evaluation. The 120 values are
cut into 24 bands of 5. Two sets of similarity 0.85 share no band with a chance below one in a million.

1. Documents with equal sets form one class; only classes go on (copies never meet pair by pair).
2. Every bucket of a band names its smallest class as pivot; each member is compared with its pivot on the
   full sets. That is one pair per member, whatever the size of the bucket.
3. Links give components. Buckets whose members are still in different components are compared in full,
   inside tasks, block against block of bounded size; identical buckets of several bands count once. Only
   the links found leave a task, never the pairs.
4. Components of all links give the smallest id reachable.

Defined cases: a NULL text or one without words has an empty set and is linked with nothing; NULL ids
take part and count as no id (a group's id is its smallest id, NULL if it has none); repeated rows are
copies; rows that share an id but not a text are different documents. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.bitmaps import bitmap, only_marked, with_mark
from kindred.shared import scratch, stored

SHINGLE = 3
PERMUTATIONS = 60
BAND_SIZE = 5
THRESHOLD = 85  # percent of the union
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1_000_000
SLICE = 512
PIECE = 1 << 16

_random = np.random.default_rng(20240607)
_FLIPS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _random.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    """Hash of a word, remembered for the words of a task; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[4]
    x = (x ^ (x >> np.uint64(29))) * _MIX[5]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    found = (text or "").encode().lower().split()
    h = np.array([hashes[w] for w in found], dtype=np.uint64)
    if len(h) >= SHINGLE:
        mixed = h[:-2] * _MIX[0] + _turn(h[1:-1] * _MIX[1], 23) + _turn(h[2:] * _MIX[2], 41)
    elif len(h) == 2:
        mixed = h[:1] * _MIX[3] + _turn(h[1:] * _MIX[1], 19)
    else:
        mixed = h * _MIX[6]
    return np.unique(_finish(mixed))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest and largest value of every set under every permutation: one row per set, none may be empty."""
    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    values = np.concatenate(sets)
    out = np.empty((len(sets), 2 * PERMUTATIONS), dtype=np.uint64)
    for j in range(PERMUTATIONS):
        permuted = (values ^ _FLIPS[j]) * _FACTORS[j]
        out[:, j] = np.minimum.reduceat(permuted, starts)
        out[:, PERMUTATIONS + j] = np.maximum.reduceat(permuted, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit number per band, the band's place mixed in."""
    cut = signature.reshape(len(signature), -1, BAND_SIZE)
    out = np.tile(np.arange(cut.shape[1], dtype=np.uint64) * _MIX[7], (len(cut), 1))
    for k in range(BAND_SIZE):
        out = _finish(_turn(out, 17) ^ (cut[:, :, k] * _MIX[k]))
    return out.astype(np.int64)


def _sketched(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingles(t.as_py(), hashes) for t in part.column("_text")]
                full = [i for i, s in enumerate(sets) if len(s)]
                lists: list = [None] * len(sets)
                nodes: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, bands(signatures([sets[i] for i in full])), strict=True):
                        lists[i] = row
                        nodes[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_hash"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(nodes, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    ["_key", "_hash", "n", "node", "bands"],
                )

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, _hash long, n long, node binary, bands array<long>")


def _could_link(n: Column, m: Column) -> Column:
    """Sets too different in size cannot reach the threshold."""
    return 100 * F.least(n, m) >= THRESHOLD * F.greatest(n, m)


def linked(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * common >= THRESHOLD * (n + m - common)


def _confirmed(pairs: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        last, last_set = None, None
        for batch in batches:
            hits = []
            for i, (a, one, other) in enumerate(zip(
                batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True
            )):
                if a != last:
                    last, last_set = a, shingles(one.as_py(), hashes)
                second = shingles(other.as_py(), hashes)
                common = len(np.intersect1d(last_set, second, assume_unique=True))
                if linked(common, len(last_set), len(second)):
                    hits.append(i)
            if hits:
                yield batch.select(["a", "b"]).take(pa.array(hits))

    return pairs.mapInArrow(run, "a binary, b binary")


def _unit_links(table: pa.Table) -> pa.Table:
    """Links inside one unit, as edges from each class to the first class it reaches in the unit."""
    hashes = _WordHashes()
    nodes = table.column("node").to_pylist()
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    nodes = [nodes[i] for i in order]
    sets = [shingles(table.column("text")[i].as_py(), hashes) for i in order]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    width = max(256, (1 << 22) // max(1, len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        first, end = np.searchsorted(column, (low, low + width))
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[first:end], column[first:end] - low] = 1
        common += part @ part.T
    near = linked(common.astype(np.int64), sizes[:, None], sizes[None, :])
    np.fill_diagonal(near, True)
    label = np.arange(len(sets))
    while True:
        lower = np.where(near, label[None, :], len(sets)).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return pa.table({
        "a": pa.array([nodes[i] for i in label[moved]], pa.binary()), "b": pa.array([nodes[i] for i in moved], pa.binary()),
    })


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: alternating large and small stars, each round stored.

    A round joins every edge with the smallest neighbour of its ends; the number of rounds grows with the
    logarithm of the number of nodes.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("_low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("_low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("_low"))
        small = large.join(least, "u").where("v != _low").select(F.col("v").alias("u"), F.col("_low").alias("v"))
        now = stored(small.union(least.select("u", F.col("_low").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))
    ).first())


def _open_units(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``unit, node``: what is left to compare in buckets that still hold several components.

    A bucket is cut by size class (sets two classes apart cannot link) and into blocks by hash; a unit
    holds two neighbouring size classes of two blocks.
    """
    labelled = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    marks = [F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y")]
    unresolved = labelled.where("c > 2").groupBy("bucket", "c").agg(
        F.min("root").alias("_first"), F.max("root").alias("_last"), F.sum("n").alias("_words"), *marks
    ).where("_first != _last")
    once = unresolved.groupBy("c", "_x", "_y").agg(F.min("bucket").alias("bucket"), F.first("_words").alias("_words"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_CLASSES), F.ceil(F.col("_words") / BLOCK_SHINGLES)).cast("int")
    rows = members.drop("c").join(once.select("bucket", blocks.alias("_blocks")), "bucket")
    size = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(THRESHOLD / 100)))).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks").cast("long")).cast("int")
    placed = rows.select("bucket", "node", "_blocks", size.alias("_size"), own.alias("_own"))
    each_size = placed.withColumn("_class", F.explode(F.array(F.col("_size"), F.col("_size") - 1)))
    each = each_size.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    unit = F.struct(
        "bucket", "_class", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j")
    )
    return each.select(unit.alias("unit"), "node")


def _links(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """All confirmed links between classes, as edges ``a, b`` that span the same components."""
    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    # Only bucket numbers are shuffled to find the buckets with company; most classes end here.
    shared = stored(banded.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    members = stored(only_marked(banded, F.col("bucket"), bitmap(shared, "bucket")).join(shared, "bucket"), "members")
    # Stored, so that the join with it is one whose large partitions can be split.
    pivots = stored(members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("pivot")), "pivots")

    needed = members.select("node").distinct().join(classes.select("node", "rep"), "node")
    named = needed.select("node", F.col("rep._key").alias("_rep_key"), F.col("rep._hash").alias("_rep_hash"))
    # The texts of other rows are dropped before the shuffle.
    asked = only_marked(rows, F.xxhash64("_key", "_hash"), bitmap(named.select(F.xxhash64("_rep_key", "_rep_hash").alias("h")), "h"))
    same = F.col("_key").eqNullSafe(F.col("_rep_key")) & (F.col("_hash") == F.col("_rep_hash"))
    texts = stored(
        asked.join(named, same).groupBy("_rep_key", "_rep_hash", "node").agg(F.first("_text").alias("text")).select("node", "text"),
        "texts",
    )

    pairs = members.join(pivots, "bucket").where((F.col("node") != F.col("pivot.node")) & _could_link(F.col("n"), F.col("pivot.n")))
    pairs = pairs.select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).distinct()
    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    stars = stored(_confirmed(with_both), "links")

    units = _open_units(members, components(stars)).join(texts, "node")
    rest = units.groupBy("unit").applyInArrow(_unit_links, "a binary, b binary")
    return stars.union(rest)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_text"))


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key, _hash, n, component, root`` per row; ``root`` is the node that names the component itself, NULL without words."""
    rows = _rows(docs, key, text)
    sketches = stored(_sketched(rows), "sketches")
    with scratch(docs.sparkSession) as keep:
        classes = stored(
            sketches.where("n > 0").groupBy("node").agg(
                F.min("_key").alias("least"), F.min(F.struct("_key", "_hash")).alias("rep"), F.first("n").alias("n"),
                F.first("bands").alias("bands"),
            ), "classes",
        )
        labels = components(_links(classes, rows)).join(classes.select("node", "least"), "node")
        smallest = labels.groupBy("root").agg(F.min("least").alias("component"))
        moved = labels.join(smallest, "root").select("node", "component", "root")
        own = F.coalesce("component", "least").alias("component")
        of_class = keep(classes.select("node", "least").join(moved, "node", "left").select("node", own, "root"), "components")
    found = sketches.select("_key", "_hash", "n", "node").join(of_class, "node", "left")
    # An unlinked class is its own root; it is stored without one.
    return found.withColumn("root", F.coalesce("root", "node")).withColumn(
        "component", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_key"))
    )


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` per row of ``docs``."""
    found = _grouped(docs, key, text)
    return found.select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("_key").eqNullSafe(F.col("component")).alias("kept"),
    )


def _losers(grouped: DataFrame) -> DataFrame:
    """``_k, _h`` of the rows that go or that stand there several times; the others have no entry here."""
    found = stored(grouped.where("n > 0").select("_key", "_hash", "root"), "groups")
    stays = found.groupBy("root").agg(F.min_by(F.struct("_key", "_hash"), F.struct(F.col("_key").isNull(), "_key", "_hash")).alias("s"))
    same = found.groupBy("_key", "_hash").agg(F.first("root").alias("root"), F.count("*").alias("_times"))
    judged = same.join(stays.select("root", F.col("s._key").alias("_stay"), F.col("s._hash").alias("_stay_hash")), "root")
    loses = ~(F.col("_key").eqNullSafe(F.col("_stay")) & (F.col("_hash") == F.col("_stay_hash")))
    return judged.select(
        F.col("_key").alias("_k"), F.col("_hash").alias("_h"), loses.alias("_loses"), (F.col("_times") > 1).alias("_again")
    ).where("_loses OR _again")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component, its columns as they were; rows without words all stay.

    The row with the smallest id stays, one without an id only if no row has one; of rows with that id the
    one with the smallest text hash, of rows equal in both the one with the smallest other columns. Texts that
    nothing links are never one group, whatever ids they have. Columns of maps cannot be compared and are an error.
    """
    with scratch(docs.sparkSession) as keep:
        flags = keep(_losers(_grouped(docs, key, text)), "losers")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_hash"))
    # Most rows are in no list: they are kept where they lie, and only the others are shuffled, once.
    listed = bitmap(flags.select(F.xxhash64("_k", "_h").alias("h")), "h")
    marked = with_mark(packed, F.xxhash64("_key", "_hash"), listed, "_may")
    joined = marked.where("_may").join(flags, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left")
    kept = stored(joined.where(~F.coalesce("_loses", F.lit(False))).select("_row", "_key", "_hash", "_again"), "kept")
    single = kept.where(~F.coalesce("_again", F.lit(False)))
    repeated = kept.where(F.coalesce("_again", F.lit(False))).groupBy("_key", "_hash").agg(F.min("_row").alias("_row"))
    return marked.where("NOT _may").select("_row.*").union(single.select("_row.*")).union(repeated.select("_row.*"))

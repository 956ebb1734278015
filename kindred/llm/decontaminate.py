"""Benchmark decontamination with one Aho-Corasick automaton over words.

Every window of 13 consecutive words of a benchmark item (or the whole of a shorter one) is a pattern.
Patterns and texts are sequences of word numbers, so the automaton has a node per word and a text is
scanned once, whatever the number of items. Word places are mapped back to character offsets of the
original text.

The words of a text get their numbers by a hash of their bytes, all at once: a running sum of byte codes
times powers, so that a word's hash is the difference of two sums, shifted to power 0. Equal words have
equal hashes, so no find is missed; what is found by hashes is confirmed by the words themselves.

The benchmark is the small side: it is read in blocks of bounded size, each block becomes one
automaton, and a benchmark larger than a block is scanned block after block with the finds stored in
between, so memory does not grow with it.

Defined cases: NULL texts and items have no words; an item without words matches nothing; a NULL item
id is listed as the empty string; items equal in text are all listed; equal ids are listed once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import LOWER_TABLE, PLAIN_WORD
from kindred.shared import stored

WINDOW = 13
# Characters of benchmark text per automaton; about 25 MB of nodes.
BLOCK_CHARS = 4_000_000
MIN_SHARE = 20  # contaminated when one word in so many is hit
PIECE = 1 << 18  # bytes of a text numbered at a time, on to the end of a word
_WORD = re.compile(PLAIN_WORD)
# Which bytes belong to a word: all of a character beyond ASCII do, as it does.
_IN_WORD = np.array([_WORD.fullmatch(chr(b).translate(LOWER_TABLE)) is not None for b in range(256)])
FOUND = "_hits array<struct<start:int,end:int>>, _items array<string>, _words long"


class WordHash:
    """64-bit hashes of the words of UTF-8 bytes, upper-case ASCII letters as lower-case ones."""

    def __init__(self, seed: int) -> None:
        drawn = np.random.default_rng(seed).integers(1, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        lowered = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
        self.codes = np.where(_IN_WORD, drawn[lowered], np.uint64(0))
        self.base = int(drawn[256])
        self._grow(PIECE)

    def _grow(self, size: int) -> None:
        """Powers of the base and of its inverse modulo 2^64 (an odd number has one)."""
        self.powers, self.inverse = np.ones((2, size + 1), dtype=np.uint64)
        np.cumprod(np.full(size, self.base, dtype=np.uint64), out=self.powers[1:])
        np.cumprod(np.full(size, pow(self.base, -1, 1 << 64), dtype=np.uint64), out=self.inverse[1:])

    def __call__(self, body: np.ndarray) -> np.ndarray:
        if len(body) > PIECE:
            return np.concatenate([self._piece(body[a:b]) for a, b in _pieces(body)])
        return self._piece(body)

    def _piece(self, body: np.ndarray) -> np.ndarray:
        size = len(body)
        if size >= len(self.powers):
            self._grow(size)
        codes = self.codes[body]
        inside = np.zeros(size + 2, dtype=np.int8)
        inside[1:-1] = codes != 0
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(codes * self.powers[:size], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.inverse[starts]


def _pieces(body: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long text, none of them inside a word."""
    start = 0
    while start < len(body):
        end = start + PIECE
        while end < len(body):
            outside = np.flatnonzero(~_IN_WORD[body[end : end + PIECE]])
            if len(outside):
                end += int(outside[0])
                break
            end += PIECE
        yield start, min(end, len(body))
        start = end


class Automaton:
    """Patterns of one block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.numbers: dict[str, int] = {}
        patterns: dict[tuple[int, ...], list[str]] = {}
        for item, text in items:
            found = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in plain_words(text)]
            for i in range(max(1, len(found) - window + 1) if found else 0):
                patterns.setdefault(tuple(found[i : i + window]), []).append(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, named in patterns.items():
            self.machine.add_word(pattern, (len(pattern), named))
        self.empty = not patterns
        if patterns:
            self.machine.make_automaton()
            self.least = min(map(len, patterns))
            self._hash_words()

    def _hash_words(self) -> None:
        """Hashes of all words of the patterns; codes are drawn anew until no two words share one."""
        together = np.frombuffer(" ".join(self.numbers).encode(), dtype=np.uint8)
        seed, hashes = 0, np.zeros(0, dtype=np.uint64)
        while len(np.unique(hashes)) < len(self.numbers):
            self.hash = WordHash(seed)
            hashes, seed = self.hash(together), seed + 1
        order = np.argsort(hashes)
        self.hashes, self.hash_numbers = hashes[order], np.arange(1, len(hashes) + 1)[order]

    def may_occur(self, hashes: np.ndarray) -> bool:
        """Does the automaton find a pattern in words of these hashes?

        Only stretches of pattern words as long as the shortest pattern are given to it.
        """
        if self.empty or len(hashes) < self.least:
            return False
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        numbers = np.where(self.hashes[at] == hashes, self.hash_numbers[at], 0)
        known = np.zeros(len(numbers) + 2, dtype=np.int8)
        known[1:-1] = numbers > 0
        edges = np.flatnonzero(np.diff(known))
        long = edges[1::2] - edges[::2] >= self.least
        return any(
            next(self.machine.iter(tuple(numbers[a:b].tolist())), None) is not None
            for a, b in zip(edges[::2][long].tolist(), edges[1::2][long].tolist(), strict=True)
        )

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges (end exclusive) inside occurrences, and the items that occur."""
        if self.empty:
            return [], set()
        number = self.numbers.get
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for end, (length, named) in self.machine.iter(tuple([number(w, 0) for w in words])):
            ranges.append((end + 1 - length, end + 1))
            items.update(named)
        return merged(ranges), items


_COUNT = WordHash(0)


def plain_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(LOWER_TABLE))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``block_chars`` characters (one longer item is a block of its own)."""
    block: list[tuple[str, str]] = []
    chars = 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        size = len(row.t or "")
        if block and chars + size > block_chars:
            yield block
            block, chars = [], 0
        block.append((row.i or "", row.t or ""))
        chars += size
    yield block


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``_hits`` (merged word ranges), ``_items`` and ``_words``; map passes only."""
    session = docs.sparkSession
    names = [c for c in docs.columns if c not in ("_hits", "_items", "_words")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*_quoted(names)).schema.fields)
    none = docs.select(
        *_quoted(names), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("_hits"),
        F.expr("CAST(array() AS array<string>)").alias("_items"), F.lit(0).cast("long").alias("_words"),
    )
    found = none
    for number, block in enumerate(_blocks(benchmark, item, item_text, block_chars)):
        if number:
            found = stored(found, "decontaminate")
        sent = session.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(sent.value, window)
            for batch in batches:
                yield _scan_batch(batch, automaton, text)

        found = found.mapInArrow(run, f"{schema}, {FOUND}")
    return found


def _quoted(names: list[str]) -> list:
    return [F.col(f"`{name}`") for name in names]


def _scan_batch(batch: pa.RecordBatch, automaton: Automaton, text: str) -> pa.RecordBatch:
    hits, items, counts = [], [], []
    before_hits, before_items = batch.column("_hits"), batch.column("_items")
    for row, body in enumerate(batch.column(text)):
        content = body.as_buffer() if body.is_valid else None
        hashes = (automaton.hash if not automaton.empty else _COUNT)(np.frombuffer(content or b"", dtype=np.uint8))
        ranges, named = automaton.scan(plain_words(body.as_py())) if automaton.may_occur(hashes) else ([], set())
        old = before_hits[row].as_py()
        if old:
            ranges = merged(ranges + [(x["start"], x["end"]) for x in old])
        hits.append([{"start": s, "end": e} for s, e in ranges])
        items.append(sorted(named | set(before_items[row].as_py())))
        counts.append(len(hashes))
    columns = {name: batch.column(name) for name in batch.schema.names}
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns |= {"_hits": pa.array(hits, place), "_items": pa.array(items, pa.list_(pa.string())),
                "_words": pa.array(np.array(counts, dtype="int64"))}
    return pa.RecordBatch.from_pydict(columns)


def spans(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with ``spans``: character offsets of the hits in the original text, end exclusive."""

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def offsets(texts, hits):
        import pandas as pd

        out = []
        for body, ranges in zip(texts, hits, strict=True):
            if ranges is None or not len(ranges):
                out.append([])
                continue
            at = [m.span() for m in _WORD.finditer(body.translate(LOWER_TABLE))]
            out.append([{"start": at[r["start"]][0], "end": at[r["end"] - 1][1]} for r in ranges])
        return pd.Series(out)

    return found.withColumn("spans", offsets(F.col(text), F.col("_hits")))


def verdicts(found: DataFrame, key: str = "doc_id", min_share: int = MIN_SHARE) -> DataFrame:
    """Per row the counts and ``contaminated``: hit at all, and one word in ``min_share`` or more."""
    n_hit = F.aggregate("_hits", F.lit(0).cast("long"), lambda total, r: total + (r["end"] - r["start"]))
    named = F.array_join(F.col("_items"), ",")
    return found.select(
        F.col(key), F.col("_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words")))


def check(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found = scan(rows, benchmark, "_text", item, item_text)
    return verdicts(found.drop("_text"), "_key").withColumnRenamed("_key", key)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", min_share: int = MIN_SHARE) -> DataFrame:
    """The rows that are not contaminated, their columns as they were."""
    rows = docs.select(F.struct(*_quoted(docs.columns)).alias("_row"), F.col(text).alias("_text"))
    found = scan(rows, benchmark, "_text")
    n_hit = F.aggregate("_hits", F.lit(0).cast("long"), lambda total, r: total + (r["end"] - r["start"]))
    contaminated = (n_hit > 0) & (min_share * n_hit >= F.col("_words"))
    return found.where(~contaminated).select("_row.*")

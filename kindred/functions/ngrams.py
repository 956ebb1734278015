"""Counting n-grams of Arrow batches: a row's n-grams are counted where the row lies.

Spark's own ``explode`` + ``groupBy`` would first send every (row, n-gram) pair over the
network. Here an n-gram is one integer, a batch is one sort, and only distinct n-grams
become strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_ROWS = 1_000  # a batch of long texts is unfolded by so many rows
_RUN_UNITS = 1_000_000  # rows are worked on in runs of about this many units
_KEY_LIMIT = 2**62
_CODE_POINTS = 0x110000


@dataclass
class Counted:
    """Distinct (row, n-gram) pairs of a run, ordered by n-gram, then by row."""

    row: np.ndarray
    tf: np.ndarray
    gram: np.ndarray  # index into ``terms``
    start: np.ndarray  # first pair of each n-gram
    terms: pa.Array


class Lookup:
    """Places of terms in a list of distinct ones; the hash table is built once and kept."""

    def __init__(self, terms: pa.Array) -> None:
        self._index = pd.Index(terms.to_numpy(zero_copy_only=False), dtype=object)

    def places(self, terms: pa.Array) -> np.ndarray:
        """-1 for a term that is not in the list."""
        return self._index.get_indexer(pd.Index(terms.to_numpy(zero_copy_only=False), dtype=object))


def term_keys(terms: pa.Array) -> np.ndarray:
    """64 bits of hash per term, the same in every process; two of 10 M terms share one with a chance of 3e-6."""
    return pd.util.hash_array(terms.to_numpy(zero_copy_only=False), categorize=False).view(np.int64)


class KeyTable:
    """Values of terms known by their keys: 16 bytes a term, so that a large dictionary can travel."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def places(self, keys: np.ndarray) -> np.ndarray:
        """-1 for a key that is not in the table."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def key_mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` body: (term, ...) -> (key, ...)."""
    for batch in batches:
        yield batch.set_column(0, "key", pa.array(term_keys(batch.column(0))))


def _count(codes: np.ndarray, lengths: np.ndarray, n: int, letters: np.ndarray, join) -> Iterator[Counted]:
    n_rows, base = len(lengths), max(2, len(letters))
    bits = (n_rows - 1).bit_length()  # a key is the n-gram and, in its last bits, the row
    if base**n << bits >= _KEY_LIMIT and n_rows > 1:
        half = n_rows // 2
        cut = int(lengths[:half].sum())
        for part in _count(codes[:cut], lengths[:half], n, letters, join):
            yield part
        for part in _count(codes[cut:], lengths[half:], n, letters, join):
            part.row += half
            yield part
        return
    places = len(codes) - n + 1
    if places < 1:
        return
    if base**n >= _KEY_LIMIT:  # one row with a huge alphabet
        grams, tf = np.unique(codes[np.arange(places)[:, None] + np.arange(n)], axis=0, return_counts=True)
        here = np.arange(len(grams))
        yield Counted(np.zeros(len(grams), np.int64), tf, here, here, join(letters[grams]))
        return
    key = codes[:places].astype(np.int64)
    for i in range(1, n):
        key *= base
        key += codes[i : i + places]
    if n_rows > 1:
        row = np.repeat(np.arange(n_rows), lengths)
        key <<= bits
        key |= row[:places]
        key = key[row[:places] == row[n - 1 :]]  # an n-gram lies in one row
        if not len(key):
            return
    if base**n << bits <= 2**32:  # short numbers sort faster
        key = key.astype(np.uint32)
    key.sort()
    pairs = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    tf = np.diff(np.append(pairs, len(key)))
    found = key[pairs].astype(np.int64)
    gram, row = found >> bits, found & ((1 << bits) - 1)
    new = np.append(True, gram[1:] != gram[:-1])
    start = np.flatnonzero(new)
    digits = gram[start][:, None] // base ** np.arange(n - 1, -1, -1) % base
    yield Counted(row, tf, np.cumsum(new) - 1, start, join(letters[digits]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _runs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges holding about ``_RUN_UNITS`` units, at least one row each."""
    start, ends = 0, np.cumsum(lengths)
    while start < len(lengths):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _RUN_UNITS, side="right")))
        yield start, stop
        start = stop


def _join_letters(letters: np.ndarray) -> pa.Array:
    if (letters == 0).any():  # a fixed-width string would lose a trailing NUL
        return pa.array(["".join(map(chr, gram)) for gram in letters.tolist()], pa.string())
    fixed = np.ascontiguousarray(letters, np.uint32).view(f"<U{letters.shape[1]}")
    return pa.array(fixed.ravel(), pa.string())


def _join_words(words: np.ndarray) -> pa.Array:
    parts = [pa.array(words[:, i], pa.string()) for i in range(words.shape[1])]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


def char_ngrams(texts: pa.Array, low: int, high: int) -> Iterator[Counted]:
    values = [t or "" for t in texts.to_pylist()]
    lengths = np.array([len(t) for t in values], np.int64)
    code_of = np.empty(_CODE_POINTS, np.int64)
    for first, stop in _runs(lengths):
        points = np.frombuffer("".join(values[first:stop]).encode("utf-32-le"), np.uint32)
        present = np.zeros(_CODE_POINTS, bool)
        present[points] = True
        letters = np.flatnonzero(present)
        code_of[letters] = np.arange(len(letters))
        codes = code_of[points]
        for n in range(low, high + 1):
            for found in _count(codes, lengths[first:stop], n, letters, _join_letters):
                found.row += first
                yield found


def word_ngrams(words: pa.Array, low: int, high: int) -> Iterator[Counted]:
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, done = words.flatten(), 0
    for first, stop in _runs(lengths):
        take = int(lengths[first:stop].sum())
        part = flat.slice(done, take).dictionary_encode()
        done += take
        letters = np.array(part.dictionary.to_pylist(), object)
        codes = part.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for n in range(low, high + 1):
            for found in _count(codes, lengths[first:stop], n, letters, _join_words):
                found.row += first
                yield found


def pairs_mapper(low: int, high: int):
    """``mapInArrow`` body: (item_id, words) -> (item_id, term, tf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            ids = batch.column(0).to_numpy()
            for c in word_ngrams(batch.column(1), low, high):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[c.row]), c.terms.take(pa.array(c.gram)), pa.array(c.tf, pa.int64())],
                    names=["item_id", "term", "tf"],
                )

    return run


def frequency_mapper(word_sizes: tuple[int, int] | None, char_sizes: tuple[int, int] | None):
    """``mapInArrow`` body: (words, chars) -> (kind, term, df, cf), summed per run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            for kind, sizes, count in (("word", word_sizes, word_ngrams), ("char", char_sizes, char_ngrams)):
                if sizes is None:
                    continue
                for c in count(batch.column(kind), *sizes):
                    df = np.diff(np.append(c.start, len(c.gram)))
                    cf = np.add.reduceat(c.tf, c.start)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(df)), c.terms, pa.array(df, pa.int64()), pa.array(cf, pa.int64())],
                        names=["kind", "term", "df", "cf"],
                    )

    return run


def _known_chars(texts: pa.Array, sizes: tuple[int, int], known: Lookup, idf: np.ndarray):
    """(row, place in the vocabulary, tf-idf) of the n-grams the vocabulary holds."""
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for c in char_ngrams(texts, *sizes):
        place = known.places(c.terms)[c.gram]
        hit = place >= 0
        parts.append((c.row[hit], place[hit], c.tf[hit] * idf[place[hit]]))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def length_mapper(
    word_sizes: tuple[int, int], char_sizes: tuple[int, int], terms: list[str], idf: list[float], shared_words
):
    """``mapInArrow`` body: (item_id, word, char) -> (item_id, key, tf, squares, char).

    One row per word n-gram that ``shared_words`` (a broadcast :class:`KeyTable` of idf) does not hold, by its key, and
    one row per item without a key: the sum of squares of the others, and the length of its character block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = Lookup(pa.array(terms, pa.string())), np.array(idf, float)
        shared = shared_words.value
        word_idf = np.nan_to_num(np.append(shared.values, 0.0))
        names = ["item_id", "key", "tf", "squares", "char"]
        for batch in _parts(batches):
            ids, n, squares = batch.column("item_id"), batch.num_rows, np.zeros(batch.num_rows)
            for c in word_ngrams(batch.column("word"), *word_sizes):
                keys = term_keys(c.terms)
                place = shared.places(keys)[c.gram]
                value = c.tf * word_idf[place]
                squares += np.bincount(c.row, value * value, minlength=n)
                other = np.flatnonzero(place < 0)
                none = pa.nulls(len(other), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(c.row[other])), pa.array(keys[c.gram[other]]), pa.array(c.tf[other], pa.int64()), none, none],
                    names=names,
                )
            row, _, value = _known_chars(batch.column("char"), char_sizes, known, weight)
            norm = pa.array(np.sqrt(np.bincount(row, value * value, minlength=n)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(squares), norm], names=names
            )

    return run


def scale_mapper(
    word_sizes: tuple[int, int], char_sizes: tuple[int, int], terms: list[str], idf: list[float],
    shared_words, idf_of_single: float | None,
):
    """``mapInArrow`` body: (item_id, text, word, char) -> (item_id, text, word, char lengths).

    ``shared_words`` is a broadcast :class:`KeyTable` with the idf of all words in two or more
    documents; a word it does not hold is in one document. A NULL idf weighs nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = Lookup(pa.array(terms, pa.string())), np.array(idf, float)
        shared = shared_words.value
        # The last entry serves the words that are not found (place -1).
        word_idf = np.nan_to_num(np.append(shared.values, np.nan if idf_of_single is None else idf_of_single))
        for batch in _parts(batches):
            n, squares = batch.num_rows, np.zeros(batch.num_rows)
            for c in word_ngrams(batch.column("word"), *word_sizes):
                value = c.tf * word_idf[shared.places(term_keys(c.terms))][c.gram]
                squares += np.bincount(c.row, value * value, minlength=n)
            row, _, value = _known_chars(batch.column("char"), char_sizes, known, weight)
            chars = np.bincount(row, value * value, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("text"), pa.array(np.sqrt(squares)), pa.array(np.sqrt(chars))],
                names=["item_id", "text", "word", "char"],
            )

    return run


def char_vector_mapper(sizes: tuple[int, int], terms: list[str], idf: list[float]):
    """``mapInArrow`` body: (item_id, char) -> (item_id, term, value), tf-idf of known n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weight = pa.array(terms, pa.string()), np.array(idf, float)
        known = Lookup(names)
        for batch in _parts(batches):
            row, place, value = _known_chars(batch.column(1), sizes, known, weight)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), names.take(pa.array(place)),
                 pa.array(weight[place]), pa.array(value)],
                names=["item_id", "term", "idf", "value"],
            )

    return run

"""Tokens of two tokenizers over the same bytes: which overlap, and where both end together.

A text is encoded by a byte-level BPE (A, after a blank) and by a piece model (B, which adds the blank itself).
All tokens of a batch of documents lie on one line of bytes. Every token points to the farthest-right token it
overlaps; a token of B whose end is also an end of A points to itself. Doubling the pointers, all at once, brings
every token to the terminal token of its component in a number of rounds that grows with the logarithm of the
longest chain; the terminal token names the group.

A link is a pair of tokens, one of A and one of B, whose bytes overlap. The count of an id pair is the number of
documents that hold it linked. Texts are encoded once; what a document needs later, its distinct pairs, is stored.
Pairs are counted by one shuffle with partial sums. The frequent pairs, whole classes of frequency and at most
``HOT_PAIRS``, are sent to all tasks, the others go through a join, so no hot pair is ever shuffled by document.

Both vocabularies come from files, whose folder is a parameter and must be there on every machine.

Defined cases: a NULL or empty text has no tokens, nor has one whose tokens do not give back its bytes (the piece
model rewrites some characters); such rows have zeros and an empty digest. Rows are counted one by one, whatever
their ids. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.shared import scratch, stored

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_PAIRS = 1_000_000  # of two numbers and a mark each, 17 MB in all
PAIR_BITS = 20  # an id pair is one number, the id of B in its lowest bits
PIECE = 1 << 20  # characters of text handled at a time; a longer text is a piece of its own
LONG_GAP = 10_000
_LONG_GAP = re.compile(rf"\s{{{LONG_GAP}}}")

# Fixed values of the byte-level vocabulary: the bytes that stand for themselves, and how text is cut before merging.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_tokens(model: dict, added: list[dict]) -> dict[bytes, int]:
    """Bytes and id of every token; ids must rise with the order of the merges, which the encoder goes by."""
    hidden = [b for b in range(256) if b not in set(SHOWN)]
    byte_of = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {token["id"] for token in added}
    merged = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    ids = [model["vocab"][m.replace(" ", "")] for m in merged]
    if ids != sorted(ids):
        raise ValueError("the ids of this vocabulary do not follow its merges")
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if i not in special}


class Tokenizers:
    """Both encoders, the bytes of every token and its number of bytes."""

    def __init__(self, folder: str, a_file: str = A_FILE, b_file: str = B_FILE):
        import sentencepiece
        import tiktoken

        self._file = f"{folder}/{a_file}"
        with open(self._file, encoding="utf-8") as source:
            whole = json.load(source)
        ranks = _byte_tokens(whole["model"], whole["added_tokens"])
        self._a = tiktoken.Encoding("bytes", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{b_file}")
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << PAIR_BITS:
            raise ValueError("a vocabulary has more ids than a pair can hold")
        # The text of an id and what follows it in a row of groups: another one of its kind, or not. One row each, zeros after it.
        shown = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
        shown += [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"]
        self.shown = np.array(shown, dtype=bytes)

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B per text; none where their bytes are not those of a blank and the text."""
        a = [self._encode_a(" " + t) if t else [] for t in texts]
        b = self._b.encode(texts, num_threads=1) if texts else []
        for i, text in enumerate(texts):
            if text:
                bytes_of = b" " + text.encode()
                if not (bytes_of == b"".join([self.a_bytes[x] for x in a[i]]) == b"".join([self.b_bytes[x] for x in b[i]])):
                    a[i], b[i] = [], []
        return a, b


    def _encode_a(self, text: str) -> list[int]:
        # The fast encoder's cutting fails on very long runs of white space; the other one takes longer for any text.
        if len(text) > LONG_GAP and _LONG_GAP.search(text):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._a.encode_ordinary(text)

    @cached_property
    def _slow(self):
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(self._file)
        encoder.encode_special_tokens = True
        return encoder


@lru_cache(maxsize=2)
def tokenizers(folder: str) -> Tokenizers:
    """Loaded once per worker process."""
    return Tokenizers(folder)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the number of its group, by pointer doubling; ends are in rising order."""
    n = len(a_end)
    to_b, to_a = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)
    ends_both = a_end[to_a] == b_end
    following = np.concatenate((n + to_b, np.where(ends_both, n + np.arange(len(b_end)), to_a)))
    while True:
        further = following[following]
        if (further == following).all():
            break
        following = further
    number = np.cumsum(ends_both) - 1
    group = number[following - n]
    return group[:n], group[n:]


def overlaps(a_end: np.ndarray, a_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places of A and B whose bytes overlap."""
    first, last = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_end, a_end)
    times = last - first + 1
    a = np.repeat(np.arange(len(a_end)), times)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + first[a]


def _own_sums(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=owners).astype(np.int64)


def align(texts: list[str], both: Tokenizers) -> dict[str, list]:
    """Everything about each text that needs no other document."""
    a_lists, b_lists = both.encode(texts)
    owners = len(texts)
    a_owner, b_owner = (np.repeat(np.arange(owners), [len(x) for x in lists]) for lists in (a_lists, b_lists))
    a, b = (np.array([x for ids in lists for x in ids], dtype=np.int64) for lists in (a_lists, b_lists))
    out = {"n_a": np.bincount(a_owner, minlength=owners), "n_b": np.bincount(b_owner, minlength=owners)}
    a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
    a_group, b_group = terminals(a_end, b_end)
    n_groups = int(b_group[-1]) + 1 if len(b) else 0

    link_a, link_b = overlaps(a_end, a_end - both.a_size[a], b_end)
    held, times = np.unique((((a_owner[link_a] << PAIR_BITS) | a[link_a]) << PAIR_BITS) | b[link_b], return_counts=True)
    cuts = np.searchsorted(held, np.arange(owners + 1) << 2 * PAIR_BITS)
    held &= (1 << 2 * PAIR_BITS) - 1
    out["pairs"] = [held[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    out["times"] = [times[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    out["n_links"] = np.bincount(a_owner[link_a], minlength=owners)

    # Tokens in the order of their groups, those of A first, each with the mark that follows it.
    in_a, in_b = (np.bincount(g, minlength=n_groups) for g in (a_group, b_group))
    line = np.empty(len(a) + len(b), dtype=np.int64)
    line[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]] = 2 * a + (np.diff(a_group, append=-1) != 0)
    line[np.arange(len(b)) + np.cumsum(in_a)[b_group]] = 2 * (len(both.a_bytes) + b) + (np.diff(b_group, append=-1) != 0)
    first_of_group = np.searchsorted(b_group, np.arange(n_groups))
    out["n_groups"] = np.bincount(b_owner[first_of_group], minlength=owners)
    letters = both.shown[line].view(np.uint8).reshape(len(line), both.shown.itemsize)
    used = letters != 0
    ends = np.concatenate(([0], np.cumsum(used.sum(axis=1))))[np.cumsum(out["n_a"] + out["n_b"])]
    whole = letters[used].tobytes()
    # The mark after the last token of a text is left out.
    starts = np.concatenate(([0], ends))[:-1]
    out["groups"] = [whole[s : max(s, e - 1)] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return out


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    first, part, size = 0, [], 0
    for i, text in enumerate(texts.to_pylist()):
        text = text or ""
        if part and size + len(text) > PIECE:
            yield first, part
            first, part, size = i, [], 0
        part.append(text)
        size += len(text)
    if part:
        yield first, part


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, with_groups: bool = False) -> DataFrame:
    """``key``, the numbers of tokens, groups and links, ``groups_sha256``, and the distinct pairs with their times."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(folder)
        for batch in batches:
            for first, texts in _pieces(batch.column("_text")):
                found = align(texts, both)
                columns = {"_key": batch.column("_key").slice(first, len(texts))}
                columns |= {name: pa.array(found[name], pa.int64()) for name in NUMBERS}
                columns["groups_sha256"] = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]])
                columns["pairs"] = pa.array(found["pairs"], pa.list_(pa.int64()))
                columns["times"] = pa.array(found["times"], pa.list_(pa.int64())).cast(pa.list_(pa.int32()))
                if with_groups:
                    columns["groups"] = pa.array([g.decode() for g in found["groups"]])
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{name} long" for name in NUMBERS)
    more = ", groups string" if with_groups else ""
    found = rows.mapInArrow(run, f"_key {kind}, {schema}, groups_sha256 string, pairs array<long>, times array<int>{more}")
    return found.withColumnRenamed("_key", key)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, c, best``: in how many rows a pair stands, and whether no pair of its A id stands in more."""
    counts = stored(pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("c")), "pairs")
    a = F.shiftright("pair", PAIR_BITS)
    # At most as many rows as A has ids.
    highest = counts.groupBy(a.alias("_a")).agg(F.max("c").alias("_highest"))
    return counts.join(F.broadcast(highest), a == F.col("_a")).select("pair", "c", (F.col("c") == F.col("_highest")).alias("best"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pairs above one frequency, at most ``most``; found from sums over classes of frequency, 16 to a doubling."""
    grade = F.floor(F.log2("c") * 16).cast("int")
    least = None
    for row in sorted(counts.groupBy(grade.alias("grade")).count().collect(), reverse=True):
        most -= row["count"]
        if most < 0:
            break
        least = row.grade
    return counts.where(F.lit(False) if least is None else grade >= least)


def _weighed(rows: DataFrame, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Sums over the frequent pairs of each row, and its other pairs."""
    sent = rows.sparkSession.sparkContext.broadcast(hot)
    other = pa.struct([("pair", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            pairs, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
            at = np.searchsorted(known, pairs).clip(0, max(0, len(known) - 1))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
            n_best, count_sum = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
            np.add.at(n_best, owner[found], times[found] * best[at[found]])
            np.add.at(count_sum, owner[found], times[found] * counts[at[found]])
            rest = ~found
            sizes = np.concatenate(([0], np.cumsum(np.bincount(owner[rest], minlength=len(lists)))))
            values = pa.StructArray.from_arrays([pa.array(pairs[rest]), pa.array(times[rest])], fields=list(other))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(n_best), pa.array(count_sum), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)],
                ["_row", "_best", "_sum", "_rest"],
            )

    return rows.select("_row", "pairs", "times").mapInArrow(run, "_row long, _best long, _sum long, _rest array<struct<pair:long,times:long>>")


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row."""
    with scratch(docs.sparkSession) as keep:
        found = aligned(docs, key, text, folder).withColumnRenamed(key, "_key").withColumn("_row", F.monotonically_increasing_id())
        rows = keep(found, "aligned")
        counts = stored(pair_counts(rows), "counts")
        hot = frequent(counts, hot_pairs).orderBy("pair").toArrow()
        weighed = stored(_weighed(rows, tuple(hot.column(c).to_numpy() for c in ("pair", "c", "best"))), "weighed")
        rest = weighed.select("_row", F.explode("_rest").alias("r")).select("_row", "r.pair", "r.times").join(counts, "pair")
        late = rest.groupBy("_row").agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("_late_best"), F.sum(F.col("times") * F.col("c")).alias("_late_sum")
        )
        sums = keep(weighed.select("_row", "_best", "_sum").join(late, "_row", "left").select("_row", _both("best"), _both("sum")), "sums")
    return rows.join(sums, "_row").select(
        F.col("_key").alias(key), *NUMBERS, F.col("best").alias("n_best"), F.col("sum").alias("count_sum"), "groups_sha256"
    )


def _both(name: str) -> Column:
    return (F.col(f"_{name}") + F.coalesce(F.col(f"_late_{name}"), F.lit(0))).cast("long").alias(name)

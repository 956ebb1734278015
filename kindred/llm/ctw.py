"""Language-model scores by context-tree weighting over bytes.

Texts are lower-cased (ASCII) and read as bytes with one closing symbol. Every byte is decomposed into
eight binary choices; each choice has a context tree over the bytes before it, with Krichevsky-Trofimov
estimates mixed over all depths by their block probabilities on the training texts.

A context is the four bytes before a symbol, as they are; the tree has a node for each of its depths 0 to 4. Counts of
contexts with their symbol are summed up inside the tasks and then by one shuffle. The model is a table as well: rows that
share the nearest byte hold a whole subtree, so each such group is weighted on its own, and only the 255 binary nodes of the
root, which the groups share, go through the driver. Contexts of held-out texts are in the table with a count of zero. A text
is scored by one look-up per byte: the most frequent rows are broadcast (2 M at most), the others are joined. A
context that no training text has ends the path: its parent stands in.

Next to it stands a word model with add-one smoothing. Its vocabulary is not bounded: the most frequent
words are broadcast, every other word of a document goes through a join with the table of counts.

Defined cases: a NULL text is empty and consists of the closing symbol; a NULL id is never held out;
repeated rows are scored one by one; without training rows every count is zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.shared import stored

FOLDS, HELD_OUT = 7, 2
DEPTH = 4  # bytes of a context
END = 0xFF  # no byte of UTF-8
NEVER = 0xFE  # neither: stands in a context for bytes that no training text has there
PAD = bytes(DEPTH)
PIECE = 1 << 22
HOT_GRAMS = 2_000_000
FLUSH_GRAMS = 4_000_000
HOT_WORDS = 100_000
HOT_BYTES = 8 * 1024 * 1024  # of all frequent words together
FLUSH_WORDS = 200_000


def prepared(text: bytes) -> bytes:
    return text.lower()  # of bytes: A-Z only


def _keys(window: np.ndarray) -> np.ndarray:
    """Context and symbol of every byte of ``window`` from its fifth on, as one number: the nearest byte highest, the symbol lowest."""
    size = len(window) - DEPTH
    keys = np.zeros(size, dtype=np.int64)
    for back in range(1, DEPTH + 1):
        keys = (keys << 8) | window[DEPTH - back : DEPTH - back + size]
    return (keys << 8) | window[DEPTH:]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts joined with padding, in pieces of bounded size: owners, first places, bytes.

    A longer text is cut; every cut repeats the bytes of a context before it.
    """
    owners: list[int] = []
    starts: list[int] = []
    parts: list[bytes] = []
    size = 0
    for owner, text in enumerate(texts):
        body = PAD + text + bytes([END])
        for at in range(DEPTH, len(body), PIECE):
            part = body[at - DEPTH : at + PIECE]
            if parts and size + len(part) > PIECE:
                yield owners, np.array(starts), np.frombuffer(b"".join(parts), dtype=np.uint8)
                owners, starts, parts, size = [], [], [], 0
            owners.append(owner)
            starts.append(size)
            parts.append(part)
            size += len(part)
    if parts:
        yield owners, np.array(starts), np.frombuffer(b"".join(parts), dtype=np.uint8)


def _own(starts: np.ndarray, size: int) -> np.ndarray:
    """Which places of a piece are symbols and not repeated bytes in front of them, from the fifth place on."""
    out = np.ones(size, dtype=bool)
    for k in range(DEPTH):
        out[starts + k] = False
    return out[DEPTH:]


def _bodies(column: pa.Array) -> list[bytes]:
    return [prepared(x or b"") for x in column.cast(pa.binary()).to_pylist()]


def counted(docs: DataFrame, text: str = "text", held: str = "held_out") -> DataFrame:
    """``gram, word, n``: counts of context-and-symbol numbers, and of words (``gram`` -1; the end is the empty word).

    Held-out rows count nothing, but what they have stands in the table with a count of zero (words do not).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        words: Counter[bytes] = Counter()
        for batch in batches:
            bodies, out = _bodies(batch.column("_text")), batch.column("_held").to_pylist()
            texts = [body for body, is_out in zip(bodies, out, strict=True) if not is_out]
            for some, step in ((texts, 1), ([body for body, is_out in zip(bodies, out, strict=True) if is_out], 0)):
                for _, starts, window in _pieces(some):
                    codes, found = pd.factorize(_keys(window)[_own(starts, len(window))])
                    parts.append((found, np.bincount(codes, minlength=len(found)) * step))
            for body in texts:
                words.update(body.split())
                if len(words) > FLUSH_WORDS:
                    yield _word_rows(words)
                    words = Counter()
            words[b""] += len(texts)
            if sum(len(found) for found, _ in parts) > FLUSH_GRAMS:
                parts = [_summed(parts)]
                if len(parts[0][0]) > FLUSH_GRAMS // 2:
                    yield from _gram_rows(*parts.pop())
        if words[b""] or len(words) > 1:
            yield _word_rows(words)
        if parts:
            yield from _gram_rows(*_summed(parts))

    rows = docs.select(F.col(text).alias("_text"), F.col(held).alias("_held"))
    return rows.mapInArrow(run, "gram long, word binary, n long").groupBy("gram", "word").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, found = pd.factorize(np.concatenate([grams for grams, _ in parts]))
    return found, np.bincount(codes, np.concatenate([n for _, n in parts]), minlength=len(found)).astype(np.int64)


def _gram_rows(grams: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(grams), 100_000):
        part = slice(at, at + 100_000)
        yield _rows(pa.array(grams[part]), pa.nulls(len(grams[part]), pa.binary()), pa.array(counts[part]))


def _rows(grams: pa.Array, words: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([grams, words, counts], ["gram", "word", "n"])


def _word_rows(words: Counter[bytes]) -> pa.RecordBatch:
    n = len(words)
    return _rows(
        pa.array(np.full(n, -1, dtype=np.int64)), pa.array(list(words.keys()), pa.binary()),
        pa.array(list(words.values()), pa.int64()),
    )


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after seven steps of the recurrence; x >= 0.5."""
    shift = np.ones_like(x)
    for k in range(7):
        shift *= x + k
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _depths(grams: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
    """Sorted numbers of context and symbol with their counts, for depths DEPTH to 1, and the place of every row one depth up."""
    tables, up = [(grams, counts)], []
    for _ in range(DEPTH - 1):
        below, n = tables[-1]
        found, place = np.unique(((below >> 16) << 8) | (below & 255), return_inverse=True)  # without the farthest byte
        tables.append((found, np.bincount(place, n, minlength=len(found))))
        up.append(place)
    return tables, up


def _levels(tables: list[tuple[np.ndarray, np.ndarray]], up: list[np.ndarray]) -> Iterator[tuple]:
    """For each of a symbol's eight choices: number of the root's binary node and weighted log of every node of depth 1, and
    for depths DEPTH to 1 the node of every row, its estimate of a one, how often it was seen and the share of its own estimate.
    """
    for level in range(8):
        out: list[tuple] = []
        for depth, (keys, n) in enumerate(tables):
            node = keys >> (8 - level)
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(node))))
            seen = np.add.reduceat(n, first)
            ones = np.add.reduceat(n * ((keys >> (7 - level)) & 1), first)
            own = _block(seen - ones, ones)
            if depth == 0:
                log_weighted, share = own, None
            else:
                below = np.bincount(which[up[depth - 1][children]], log_weighted, minlength=len(first))
                log_weighted, share = np.logaddexp(own, below) - np.log(2), _share(own, below)
            children = first
            out.append((which, (ones + 0.5) / (seen + 1), seen, share))
        keys = tables[-1][0][children]
        yield _heap(keys, level), log_weighted, out


def _heap(keys: np.ndarray, level: int) -> np.ndarray:
    """Number of the binary node that the first ``level`` bits of a symbol lead to; 1 is the first."""
    return (1 << level) | ((keys & 255) >> (8 - level))


def _share(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def _tops(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the weighted logs of depth 1 for the root's 256 binary nodes (the first is none)."""
    out = np.zeros(256)
    for heap, log_weighted, _ in _levels(*_depths(grams, counts)):
        out += np.bincount(heap, log_weighted, minlength=256)
    return out


def _root(symbols: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimate of a one and share of it, for the root's binary nodes, from counts of the 256 symbols and sums of depth 1."""
    one, share = np.full(256, 0.5), np.full(256, 0.5)
    for level in range(8):
        part = slice(1 << level, 2 << level)
        split = symbols.reshape(1 << level, 2, -1).sum(axis=2)
        one[part] = (split[:, 1] + 0.5) / (split.sum(axis=1) + 1)
        share[part] = _share(_block(split[:, 0], split[:, 1]), below[part])
    return one, share


def _logs(grams: np.ndarray, counts: np.ndarray, root: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Log10 of the probability of each symbol after its context. Rows are sorted and hold whole subtrees of depth 1."""
    tables, up = _depths(grams, counts)
    rows = [np.arange(len(grams))]
    for place in up:
        rows.append(place[rows[-1]])
    out = np.zeros(len(grams))
    for level, (_, _, depths) in enumerate(_levels(tables, up)):
        heap = _heap(grams, level)
        estimate = root[0][heap]
        ways, shares = [estimate], [root[1][heap]]
        for (which, one, seen, share), row in zip(reversed(depths), reversed(rows), strict=True):
            node = which[row]
            estimate = np.where(seen[node] > 0, one[node], estimate)
            ways.append(estimate)
            shares.append(None if share is None else share[node])
        chance = ways[DEPTH]
        for depth in range(DEPTH - 1, -1, -1):
            chance = shares[depth] * ways[depth] + (1 - shares[depth]) * chance
        out += np.log10(np.where((grams >> (7 - level)) & 1 == 1, chance, 1 - chance))
    return out


def weighted(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A small model as a whole: sorted contexts, and log10 of all 256 symbols' probabilities after each.

    Contexts that end earlier are filled up with a byte that no text has.
    """
    contexts = [np.array([_ending(0, 0)])]
    for depth in range(1, DEPTH + 1):
        contexts.append(_ending(np.unique(grams >> (8 * (DEPTH - depth) + 8)), depth))
    known = np.unique(np.concatenate(contexts)).astype(np.int64)
    every = ((known[:, None] << 8) | np.arange(256)).ravel()
    n = np.zeros(len(every))
    n[np.searchsorted(every, grams)] = counts
    root = _root(np.bincount(every & 255, n, minlength=256), _tops(every, n))
    return known, _logs(every, n, root).reshape(-1, 256).astype(np.float32)


def _ending(context: np.ndarray, depth: int) -> np.ndarray:
    """A context of the nearest ``depth`` bytes with nothing known before them."""
    for _ in range(DEPTH - depth):
        context = (context << 8) | NEVER
    return context


def log_probabilities(texts: list[bytes], contexts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log10 probability of each text and its closing symbol, by a model as a whole."""

    def look_up(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.zeros(len(keys), dtype=np.int64)
        for depth in range(DEPTH + 1):  # the deepest known one stays
            wanted = _ending(keys >> (8 * (DEPTH - depth) + 8), depth)
            at = np.searchsorted(contexts, wanted).clip(0, len(contexts) - 1)
            row = np.where(contexts[at] == wanted, at, row)
        return table[row, keys & 255].astype(np.float64), np.ones(len(keys), dtype=bool)

    return _sums(texts, look_up)[0]


def _sums(texts: list[bytes], look_up) -> tuple[np.ndarray, list[list[int]]]:
    """Sums of what ``look_up`` gives for the numbers of each text, and the numbers it does not know, one by one."""
    out, rest = np.zeros(len(texts)), [[] for _ in texts]
    for owners, starts, window in _pieces(texts):
        codes, found = pd.factorize(_keys(window))
        values, known = look_up(found)
        own = _own(starts, len(window))
        logs = np.where(known, values, 0.0)[codes]
        logs[~own] = 0.0
        # The first symbol of a part stands a context after its start, which is where ``logs`` begins.
        np.add.at(out, owners, np.add.reduceat(logs, starts))
        if not known.all():
            at = np.flatnonzero(own & ~known[codes])
            for part, gram in zip((np.searchsorted(starts, at, side="right") - 1).tolist(), found[codes[at]].tolist(), strict=True):
                rest[owners[part]].append(gram)
    return out, rest


def model(counts: DataFrame) -> DataFrame:
    """``gram, n, log``: the finished model, from ``gram, n``. The rows of one nearest byte are a group, 2 ** 32 at most by definition."""
    symbols, below = np.zeros(256), np.zeros(256)
    for row in counts.groupBy(F.col("gram").bitwiseAND(F.lit(255)).alias("symbol")).agg(F.sum("n").alias("n")).collect():  # at most 256
        symbols[row.symbol] = row.n
    groups = counts.groupBy(F.shiftright("gram", 8 * DEPTH).alias("nearest"))

    def ordered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        table = table.sort_by("gram")
        return table.column("gram").to_numpy(), table.column("n").to_numpy().astype(float)

    def tops(table: pa.Table) -> pa.Table:
        return pa.table({"node": pa.array(np.arange(256), pa.int32()), "log": pa.array(_tops(*ordered(table)))})

    for row in groups.applyInArrow(tops, "node int, log double").groupBy("node").agg(F.sum("log").alias("log")).collect():  # 256
        below[row.node] = row.log
    root = _root(symbols, below)

    def logs(table: pa.Table) -> pa.Table:
        grams, n = ordered(table)
        return pa.table({"gram": pa.array(grams), "n": pa.array(n.astype(np.int64)), "log": pa.array(_logs(grams, n, root))})

    return groups.applyInArrow(logs, "gram long, n long, log double")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def frequent(vocabulary: DataFrame, most: int, most_bytes: int = HOT_BYTES) -> DataFrame:
    """The words above one frequency: at most ``most`` of them with ``most_bytes`` in all.

    Words are counted by classes of frequency, 16 to a doubling, so finding the limit takes some
    hundred numbers and no sort. The other words are joined.
    """
    grade = F.floor(F.log2("n") * 16).cast("int")
    grades = vocabulary.groupBy(grade.alias("grade")).agg(
        F.count("*").alias("words"), F.sum(F.octet_length("word")).alias("bytes")
    )
    least = None
    for row in sorted(grades.collect(), reverse=True):
        most, most_bytes = most - row.words, most_bytes - row.bytes
        if most < 0 or most_bytes < 0:
            break
        least = row.grade
    return vocabulary.where(F.lit(False) if least is None else grade >= least)


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS, hot_grams: int = HOT_GRAMS
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` per row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), held_out(F.col(key)).alias("held_out"))
    counts = stored(counted(rows, "_text"), "lm-counts")
    vocabulary = counts.where("gram = -1").select("word", "n")
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.count("*").alias("distinct")).first()
    grams = stored(model(counts.where("gram >= 0").select("gram", "n")), "lm-model")
    all_hot = grams.count() <= hot_grams
    often = grams if all_hot else frequent(grams.where("n > 0").withColumn("word", F.lit("")), hot_grams)
    table = often.select("gram", "log").toArrow().sort_by("gram")
    hot = {bytes(r.word): r.n for r in frequent(vocabulary, hot_words).toLocalIterator()}
    sent = spark.sparkContext.broadcast(((table.column("gram").to_numpy(), table.column("log").to_numpy()), hot))
    scored = stored(_scored(rows, sent), "lm-scored")

    rest = scored.select("_row", F.explode("_rest").alias("r")).select("_row", "r.word", "r.times")
    known = rest.join(vocabulary, "word").groupBy("_row").agg(
        F.sum("times").alias("_rest_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_rest_sum")
    )
    whole = scored.drop("_rest", "_far").join(known, "_row", "left").withColumn("_far_sum", F.lit(0.0))
    if not all_hot:
        far = scored.select("_row", F.explode("_far").alias("gram")).join(grams, "gram")
        whole = whole.drop("_far_sum").join(far.groupBy("_row").agg(F.sum("log").alias("_far_sum")), "_row", "left")
    whole = whole.withColumn("score", F.col("score") + F.coalesce("_far_sum", F.lit(0.0)))
    per_token = F.log10(F.lit(float(size["all"] + size["distinct"] + 1)))
    return whole.select(
        F.col("_key").alias(key), "held_out", "n_tokens",
        (F.col("_hot_known") + F.coalesce("_rest_known", F.lit(0))).alias("n_known"),
        F.lit(int(size["all"])).cast("long").alias("train_tokens"),
        (F.col("_hot_sum") + F.coalesce("_rest_sum", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        "score", (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def _scored(rows: DataFrame, sent) -> DataFrame:
    """Model scores and sums over frequent words, the other words with their number of times, and the numbers of rare contexts."""
    other = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (grams, logs), hot = sent.value
        lift = {word: np.log10(n + 1) for word, n in hot.items()}

        def look_up(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(grams):
                return np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
            at = np.searchsorted(grams, keys).clip(0, len(grams) - 1)
            return logs[at], grams[at] == keys

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                texts = _bodies(part.column("_text"))
                tokens, known, sums, rest = [], [], [], []
                for body in texts:
                    times = Counter(body.split())
                    times[b""] += 1
                    found = [(n, lift[w]) for w, n in times.items() if w in lift]
                    tokens.append(sum(times.values()))
                    known.append(sum(n for n, _ in found))
                    sums.append(float(sum(n * value for n, value in found)))
                    rest.append([{"word": w, "times": n} for w, n in times.items() if w not in lift])
                scores, far = _sums(texts, look_up)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(sums, pa.float64()), pa.array(scores),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array(rest, other),
                     pa.array(far, pa.list_(pa.int64()))],
                    ["_key", "held_out", "n_tokens", "_hot_known", "_hot_sum", "score", "n_bytes", "_rest", "_far"],
                )

    kind = rows.schema["_key"].dataType.simpleString()
    schema = (f"_key {kind}, held_out boolean, n_tokens long, _hot_known long, _hot_sum double, score double, "
              "n_bytes long, _rest array<struct<word:binary,times:long>>, _far array<long>")
    return rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id())

"""Repeated passages against a plain version that compares all windows."""

import hashlib
import random
import re

import pytest

from kindred.llm import substring_dups

SPACES = "[\x20\x09-\x0d]+"
LONG = "one two three four five six seven eight nine ten " * 3000
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "single"), (5, LONG), (6, LONG), (6, LONG), (7, "intro " + PASSAGE + " outro"),
    (8, PASSAGE), (9, " ".join(f"own{i}" for i in range(19))), (10, " ".join(f"own{i}" for i in range(19))),
    (11, "é ü " + PASSAGE.replace(" ", "\n\t")), (12, PASSAGE + " " + PASSAGE), (None, PASSAGE + " without an id"),
    (None, PASSAGE + " nor this"), (13, "a b a b a b " * 30), (13, PASSAGE + " another text of thirteen"), (14, "the same text twice"),
]


def words_of(text):
    return [w for w in re.split(SPACES, text or "") if w]


def plain(rows, window):
    """Word by word; texts are ordered by id, then by a hash, equal rows are one text."""
    order = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, {}
    for place, row in enumerate(order):
        words = words_of(row[1])
        for i in range(len(words) - window + 1):
            seen.setdefault(tuple(words[i : i + window]), (place, i))
    for place, row in enumerate(order):
        words = words_of(row[1])
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] != (place, i):
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out[row] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return sorted((str(r[0]), *out[r]) for r in rows)


def random_rows(seed, documents, vocabulary, most):
    """Texts over a small vocabulary that quote each other, whole and in part."""
    rng = random.Random(seed)
    rows = []
    for i in range(documents):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(most))]
        for _ in range(rng.randrange(3)):
            if rows:
                other = rng.choice(rows)[1].split()
                start = rng.randrange(len(other) + 1)
                at = rng.randrange(len(words) + 1)
                words[at:at] = other[start : start + rng.randrange(60)]
        rows.append((i * 7 % documents, " ".join(words) if rng.random() < 0.9 or not rows else rng.choice(rows)[1]))
    return rows


def answer(frame):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())


@pytest.mark.parametrize(("rows", "window"), [
    (random_rows(1, 60, 400, 200), 20), (random_rows(2, 40, 2, 90), 20), (random_rows(3, 40, 5, 60), 6), (random_rows(4, 30, 50, 300), 50),
], ids=["quotes", "periodic", "short", "long"])
def test_repeats(spark, rows, window):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(substring_dups.repeats(docs, window=window)) == plain(rows, window)


def test_odd_rows(spark):
    # Texts of one id, and of none, are ordered by a hash: rows that depend on it are left to the next test.
    rows = [r for r in ODD if r[0] not in (None, 13)]
    docs = spark.createDataFrame([(*r, 1, True, 5, "x") for r in rows], "doc_id long, text string, n long, kept boolean, rank int, _key string")
    found = substring_dups.repeats(docs)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
    assert answer(found) == plain(rows, 20)
    for row in found.collect():
        assert sum(s.end - s.start for s in row.spans) == row.n_removed


def test_rows_of_one_id(spark):
    found = substring_dups.repeats(spark.createDataFrame(ODD, "doc_id long, text string")).collect()
    assert len(found) == len(ODD)
    without = sorted(r.n_removed for r in found if r.doc_id is None)
    assert without == [60, 60]  # their passage stands in documents with an id
    assert {r.n_removed for r in found if r.doc_id == 6} == {30000}
    assert sorted(r.n_removed for r in found if r.doc_id == 13) == [60, 178]  # of "a b a b" the first two words stay
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dups.repeats(empty).collect() == []
    assert substring_dups.extended(empty).collect() == []


def test_extended(spark):
    rows = random_rows(5, 30, 300, 150) + [(100, PASSAGE), (101, "x " + PASSAGE), (102, LONG[:600])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.length, r.n_windows) for r in substring_dups.extended(docs).collect())
    leaders = {}
    for key, text in sorted(rows):
        leaders.setdefault(text, key)
    expected, length = [], 20
    while True:
        places = {}
        for text, key in leaders.items():
            words = words_of(text)
            for i in range(len(words) - length + 1):
                places.setdefault(tuple(words[i : i + length]), []).append(key)
        again = [key for keys in places.values() if len(keys) > 1 for key in keys]
        if not again:
            break
        expected += [(key, length, again.count(key)) for key in set(again)]
        length *= 2
    assert got == sorted(expected)
    assert max(length for _, length, _ in got) >= 40


def test_window_must_be_even(spark):
    with pytest.raises(ValueError, match="even"):
        substring_dups.repeats(spark.createDataFrame([], "doc_id long, text string"), window=7)

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pyarrow as pa

from kindred.functions import ngrams, tokens


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Mix the eggs, 2 cups flour and all-purpose salt.", ["cup", "egg", "flour", "mix", "salt"]),
        ("It's done... don't stir! (Chill) 1,000 times.", ["chill", "done", "stir", "time"]),
        ("Cook's pie: apples;pears--plums", ["apple", "cook", "pear", "pie", "plum"]),
        ('He said "serve."', ["said", "serve"]),
        ("Crème brûlée, 2ème", ["2ème", "brûlée", "crème"]),
        ("a b c d", ["b", "c"]),
        ("1 2 3", []),
        ("", []),
    ],
)
def test_unique_words(value, text, expected):
    assert value(tokens.unique_words, text) == expected


def test_word_overlap(spark):
    frame = spark.createDataFrame(
        [(["tin", "moss", "sand"], ["river"], ["sand", "tin"], ["moss", "river"])],
        "a array<string>, b array<string>, c array<string>, d array<string>",
    )
    score = tokens.word_overlap([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])
    assert frame.select(score.alias("n")).first()["n"] == 3


def test_char_text(value):
    assert value(tokens.char_text, "A \n\t B\nC  D") == "a b\nc d"


def _brute(rows, low, high, join):
    out = {}
    for i, units in enumerate(rows):
        for n in range(low, high + 1):
            for at in range(len(units) - n + 1):
                key = (i, n, join(units[at : at + n]))
                out[key] = out.get(key, 0) + 1
    return out


def _counted(parts):
    out = {}
    for c in parts:
        terms = c.terms.to_pylist()
        for row, gram, tf in zip(c.row.tolist(), c.gram.tolist(), c.tf.tolist(), strict=True):
            key = (row, terms[gram])
            out[key] = out.get(key, 0) + tf
    return out


def _flat(counts):
    out = {}
    for (i, _, term), tf in counts.items():
        out[(i, term)] = out.get((i, term), 0) + tf
    return out


text = st.text(st.sampled_from("ab é\n\x00😀汉"), max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | text, max_size=5), st.sampled_from([3, 500_000]))
def test_char_ngrams_equal_brute_force(rows, run):
    before, ngrams._RUN_UNITS = ngrams._RUN_UNITS, run
    try:
        found = _counted(ngrams.char_ngrams(pa.array(rows, pa.string()), 2, 4))
    finally:
        ngrams._RUN_UNITS = before
    assert found == _flat(_brute([r or "" for r in rows], 2, 4, "".join))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(["a", "b", "é", "long"]), max_size=6), max_size=5))
def test_word_ngrams_equal_brute_force(rows):
    found = _counted(ngrams.word_ngrams(pa.array(rows, pa.list_(pa.string())), 1, 2))
    assert found == _flat(_brute([r or [] for r in rows], 1, 2, " ".join))


def test_huge_alphabet(monkeypatch):
    rows = ["abcabc", "bcab", "zzz"]
    for limit in (1, 50, 5000):
        monkeypatch.setattr(ngrams, "_KEY_LIMIT", limit)
        found = _counted(ngrams.char_ngrams(pa.array(rows), 2, 4))
        assert found == _flat(_brute(rows, 2, 4, "".join))


def test_sliced_batches():
    words = pa.array([["x"], ["a", "b", "a"], ["b"]]).slice(1, 2)
    assert _counted(ngrams.word_ngrams(words, 1, 2)) == {
        (0, "a"): 2, (0, "b"): 1, (0, "a b"): 1, (0, "b a"): 1, (1, "b"): 1,
    }


def test_word_terms_keep_order_and_repeats(value):
    out = value(tokens.word_terms, "Boil the Water, boil it; x 10 ml")
    assert out == ["boil", "water", "boil", "10", "ml"]
    assert all(re.fullmatch(r"\w{2,}", w) for w in out)

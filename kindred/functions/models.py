"""Encoders and classifiers plugged into Spark as iterator pandas UDFs.

A model is a *factory*: a picklable function without arguments that returns a batch
function. It runs once per Python worker process, so weights load there and not per task.
A missing text reaches the model as "".

* encoder factory -> ``f(list[str]) -> array (n, dim)``
* classifier factory -> ``f(list[str], labels) -> list[(label, score)]``, best label only

The defaults need no download. They are NOT neural: the encoder hashes token counts,
the classifier counts lexicon keywords.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import constants as K

Encoder = Callable[[list[str]], np.ndarray]
Classifier = Callable[[list[str], Sequence[str]], list[tuple[str, float]]]

_WORD = re.compile(r"[^\W_]+")
_KEPT_WORDS = 50_000  # slots remembered by a worker; others are hashed again
_ROWS = 1_000  # texts encoded at a time


def _hash_slots(word: str, dim: int) -> tuple[int, float]:
    digest = hashlib.md5(word.encode()).hexdigest()
    return int(digest[:8], 16) % dim, 1.0 if int(digest[8], 16) < 8 else -1.0


def hashing_encoder(dim: int = 64) -> Encoder:
    """Signed token counts hashed into ``dim`` slots, unit length."""
    slots: dict[str, tuple[int, float]] = {}

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, text in enumerate(texts):
            for word in _WORD.findall(text.lower()):
                if word not in slots:
                    if len(slots) >= _KEPT_WORDS:
                        slots.clear()
                    slots[word] = _hash_slots(word, dim)
                at, sign = slots[word]
                out[i, at] += sign
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(norms == 0, 1.0, norms)

    return encode


def lexicon_classifier(lexicon: Mapping[str, Sequence[str]]) -> Classifier:
    """Share of a text's keywords that belong to a label; uniform without a keyword."""
    owner: dict[str, list[str]] = {}
    for label, words in lexicon.items():
        for word in words:
            owner.setdefault(word, []).append(label)

    def classify(texts: list[str], labels: Sequence[str]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            hits = dict.fromkeys(labels, 0)
            for word in _WORD.findall(text.lower()):
                for label in owner.get(word, ()):
                    if label in hits:
                        hits[label] += 1
            total = sum(hits.values())
            best = max(labels, key=lambda label: hits[label])  # first label wins a tie
            out.append((best, hits[best] / total if total else 1.0 / len(labels)))
        return out

    return classify


def lexicon_label(text: Column, lexicon: Mapping[str, Sequence[str]], labels: Sequence[str]) -> Column:
    """The same best label and score as :func:`lexicon_classifier`, as columns and without Python."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)[^\W_]+"), F.lit(0))

    def hits_of(words: Column, name: str) -> Column:
        own = list(lexicon.get(name, ()))
        return F.size(F.filter(words, lambda w: w.isin(own)))

    def best(words: Column) -> Column:
        counted = [
            F.struct(hits_of(words, name).alias("hits"), F.lit(-i).alias("turn"), F.lit(name).alias("label"))
            for i, name in enumerate(labels)
        ]
        return F.transform(F.array(F.array(*counted)), scored)[0]

    def scored(hits: Column) -> Column:
        total = F.aggregate(hits, F.lit(0), lambda n, h: n + h["hits"])
        first = F.array_max(hits)  # most hits; the first label wins a tie
        share = F.when(total > 0, first["hits"] / total).otherwise(F.lit(1.0 / len(labels)))
        return F.struct(first["label"].alias("label"), share.alias("score"))

    return F.transform(F.array(found), best)[0]


DEFAULT_ENCODER = partial(hashing_encoder, 64)
COOKING_CLASSIFIER = partial(lexicon_classifier, K.COOKING_LEXICON)
INGREDIENT_CLASSIFIER = partial(lexicon_classifier, K.INGREDIENT_LEXICON)


_MOST_MODELS = 4
_LOADED: dict[str, Callable] = {}


def _name(factory: Callable[[], Callable]) -> str:
    """Equal for equal factories, so that every task of a worker finds the same model."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def _loaded(name: str, factory: Callable[[], Callable]) -> Callable:
    """The model of a factory, kept in the worker process; the oldest goes when there are too many."""
    if name not in _LOADED:
        if len(_LOADED) >= _MOST_MODELS:
            del _LOADED[next(iter(_LOADED))]
        _LOADED[name] = factory()
    return _LOADED[name]


def encode(text: Column, factory: Callable[[], Encoder] = DEFAULT_ENCODER) -> Column:
    """Embedding of one text column."""
    return encode_fields([text], factory)


def encode_fields(
    fields: Sequence[Column], factory: Callable[[], Encoder] = DEFAULT_ENCODER
) -> Column:
    """One vector per field, laid side by side in the order given; one Python pass for all fields."""
    name = _name(factory)

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        encoder = _loaded(name, factory)
        for batch in batches:
            texts = batch if isinstance(batch, tuple) else (batch,)
            out: list[np.ndarray] = []
            for at in range(0, len(texts[0]), _ROWS):
                sides = [np.asarray(encoder(t.iloc[at : at + _ROWS].fillna("").tolist()), np.float32) for t in texts]
                out.extend(np.hstack(sides))
            yield pd.Series(out, index=texts[0].index, dtype=object)

    return run(*fields)


def classify(
    text: Column,
    labels: Sequence[str],
    factory: Callable[[], Classifier],
    batch_size: int = K.CLASSIFIER_BATCH,
) -> Column:
    """Best label and its score, ``struct<label, score>``, in batches of ``batch_size``."""
    names, name = list(labels), _name(factory)

    @F.pandas_udf("struct<label:string,score:double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = _loaded(name, factory)
        for texts in batches:
            values, out = texts.fillna("").tolist(), []
            for start in range(0, len(values), batch_size):
                out.extend(classifier(values[start : start + batch_size], names))
            yield pd.DataFrame(out, columns=["label", "score"])

    return run(text)

"""The most frequent character n-grams in two passes, without a table of all n-grams.

First pass: each task keeps a Misra-Gries summary, a bounded number of counters. When they run over, all are lowered by
the same amount and the empty ones go; the amounts add up to the most a count can be short. Summaries are added up.
Second pass: exact counts of the terms with the largest estimates, and of nothing else. If the last term of the result is
not more frequent than any left-out term could be, the summaries are doubled and it starts again, so the result is
always exact; a summary that never ran over holds everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.ngrams import Lookup, char_ngrams
from kindred.plans.tfidf_search import smooth_idf, units
from kindred.shared import scratch, stored

KEPT = 4  # counters for each term of the result


class Summary:
    """At most ``size`` counters after each lowering; ``short`` is the most a count can lack."""

    def __init__(self, size: int):
        self.size, self.short, self.counts = size, 0, {}

    def add(self, terms: list[str], counts: list[int]) -> None:
        have = self.counts
        for term, n in zip(terms, counts, strict=True):
            have[term] = have.get(term, 0) + n
        if len(have) > 2 * self.size:
            self.lower()

    def lower(self) -> None:
        if len(self.counts) <= self.size:
            return
        by = int(np.partition(np.fromiter(self.counts.values(), np.int64), -self.size - 1)[-self.size - 1])
        self.short += by
        self.counts = {term: n - by for term, n in self.counts.items() if n > by}


def summaries(docs: DataFrame, size: int, sizes: tuple[int, int] = K.CHAR_NGRAMS) -> DataFrame:
    """``term, n``: estimates, never too high, summed over all tasks; the NULL term has what they can be short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            for c in char_ngrams(batch.column("char"), *sizes):
                summary.add(c.terms.to_pylist(), np.add.reduceat(c.tf, c.start).tolist())
        summary.lower()
        terms = [*summary.counts, None]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([*summary.counts.values(), summary.short], pa.int64())], ["term", "n"])

    return units(docs).select("char").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def exact_counts(docs: DataFrame, terms: pa.Array, sizes: tuple[int, int] = K.CHAR_NGRAMS) -> DataFrame:
    """``term, df, cf`` of some terms; each task sends one row per term at most."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lookup(shared.value)
        df, cf = (np.zeros(len(shared.value) + 1, np.int64) for _ in range(2))  # the last place takes all other terms
        for batch in batches:
            for c in char_ngrams(batch.column("char"), *sizes):
                place = known.places(c.terms)
                np.add.at(df, place, np.diff(np.append(c.start, len(c.gram))))
                np.add.at(cf, place, np.add.reduceat(c.tf, c.start))
        met = np.flatnonzero(df[:-1])
        yield pa.RecordBatch.from_arrays([shared.value.take(pa.array(met)), pa.array(df[met]), pa.array(cf[met])], ["term", "df", "cf"])

    return units(docs).select("char").mapInArrow(run, "term string, df long, cf long").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("cf").alias("cf")
    )


def char_vocabulary(
    docs: DataFrame, n: int, max_df: float = K.MAX_DF, most: int = K.MAX_CHAR_FEATURES, size: int | None = None,
    report: list | None = None,
) -> DataFrame:
    """(term, df, cf, idf): the ``most`` most frequent n-grams of the documents, ties by term; ``report`` gets the summary sizes tried."""
    size = size or KEPT * most
    with scratch(docs.sparkSession) as keep:
        while True:
            found = stored(summaries(docs, size), "summaries")
            short = found.where("term IS NULL").select("n").first()
            # Bounded: ``size`` terms and the next estimate.
            best = found.where("term IS NOT NULL").orderBy(F.col("n").desc(), "term").limit(size + 1).toArrow()
            left_out = (best.column("n")[size].as_py() if len(best) > size else 0) + (short[0] if short else 0)
            terms = best.column("term").slice(0, size).combine_chunks()
            counted = exact_counts(docs, terms).where(F.col("df") <= max_df * n)
            top = keep(counted.orderBy(F.col("cf").desc(), "term").limit(most), "vocabulary")
            last = top.agg(F.count("*"), F.min("cf")).first()
            if report is not None:
                report.append(size)
            if left_out == 0 or (last[0] == most and last[1] > left_out):
                return top.select("term", "df", "cf", smooth_idf(n, F.col("df")).alias("idf"))
            size *= 2

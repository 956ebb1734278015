"""Words and small column idioms the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# A plain word is a run of ASCII letters, digits and characters beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Every upper-case letter of ASCII and its lower-case one; no other letter is changed.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LOWER_TABLE = str.maketrans(UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of words; a NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP, -1), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def map_texts(docs: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a batch function to every Arrow batch of ``docs``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return docs.mapInArrow(run, schema)

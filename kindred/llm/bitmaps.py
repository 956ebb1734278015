"""A set of hashes as bits, to drop rows before a shuffle that an exact join would drop after it.

The set has a fixed number of bits, so its size does not grow with the data: at most ``BITS / 64`` rows of two
numbers are broadcast. A row whose bit is not set is certainly not in the set; one whose bit is set may be,
and the join that follows decides. A set that fills up lets more rows through, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB, in 2 ** 20 rows


def bitmap(hashes: DataFrame, column: str) -> DataFrame:
    """``_word, _set``: the bits of all values of a column of 64-bit hashes."""
    place = hashes.select(F.pmod(F.col(column), F.lit(BITS)).alias("_place"))
    parts = place.selectExpr("shiftright(_place, 6) AS _word", "shiftleft(1L, cast(_place % 64 AS int)) AS _one")
    return parts.groupBy("_word").agg(F.bit_or("_one").alias("_set"))


def with_mark(rows: DataFrame, value: Column, bits: DataFrame, mark: str) -> DataFrame:
    """``rows`` and a boolean: may the 64-bit ``value`` be in the set?"""
    marked = rows.withColumn("_place", F.pmod(value, F.lit(BITS))).withColumn("_word", F.shiftright("_place", 6))
    found = marked.join(F.broadcast(bits), "_word", "left")
    hit = F.expr("coalesce(_set & shiftleft(1L, cast(_place % 64 AS int)), 0L) <> 0")
    return found.withColumn(mark, hit).drop("_word", "_place", "_set")


def only_marked(rows: DataFrame, value: Column, bits: DataFrame) -> DataFrame:
    """The rows whose ``value`` may be in the set."""
    return with_mark(rows, value, bits, "_may").where("_may").drop("_may")

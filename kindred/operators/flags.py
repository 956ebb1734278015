"""Multi-hot flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flags_of_array(groups: Column, vocabulary: Sequence[str], names: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per vocabulary entry; NULL groups give 0. No shuffle."""
    return {
        name: F.coalesce(F.array_contains(groups, entry).cast("int"), F.lit(0))
        for entry, name in zip(vocabulary, names, strict=True)
    }


def flags_of_rows(
    rows: DataFrame, key: str, group: str, vocabulary: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """The same from (key, group) rows; summed up map-side before the one shuffle."""
    one = [
        F.coalesce(F.max((F.col(group) == entry).cast("int")), F.lit(0)).alias(name)
        for entry, name in zip(vocabulary, names, strict=True)
    ]
    return rows.groupBy(key).agg(*one)

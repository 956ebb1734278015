"""Facets packed into bits: one number per item instead of a column per flag and label.

A flag is one bit; a label has one bit for each of its values. To exclude groups is one AND with a mask, to accept
some methods another, and the number of facets equal to a query's is the bit count of an AND with the query's own
bits. A layout that needs more than 63 bits takes several numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 63


@dataclass(frozen=True)
class PackedFacets:
    """Which values of which columns have a bit; values without one are lost."""

    values: tuple[tuple[str, tuple], ...]

    @classmethod
    def of(cls, flags: Sequence[str] = (), labels: Mapping[str, Sequence] | None = None) -> PackedFacets:
        """``flags`` are 0/1 columns; ``labels`` maps a column to its values."""
        return cls((*((f, (1,)) for f in flags), *((c, tuple(v)) for c, v in (labels or {}).items())))

    def _places(self) -> dict[tuple[str, object], int]:
        every = [(column, value) for column, values in self.values for value in values]
        return {pair: i for i, pair in enumerate(every)}

    def names(self) -> list[str]:
        return [f"bits_{i}" for i in range(-(-len(self._places()) // WORD_BITS))]

    def _masks(self, pairs: Sequence[tuple[str, object]]) -> list[int]:
        places, masks = self._places(), [0] * len(self.names())
        for column, value in pairs:
            if column not in dict(self.values):
                raise ValueError(f"{column} has no bits")
            place = places.get((column, value))
            if place is not None:
                masks[place // WORD_BITS] |= 1 << place % WORD_BITS
        return masks

    def pack(self, table: DataFrame, *keep: str) -> DataFrame:
        """The kept columns and the numbers; NULL sets no bit."""
        words: list[list[Column]] = [[] for _ in self.names()]
        for (column, value), place in self._places().items():
            bit = F.lit(1 << place % WORD_BITS).cast("bigint")
            words[place // WORD_BITS].append(F.when(F.col(column) == F.lit(value), bit).otherwise(F.lit(0).cast("bigint")))
        packed = [reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name) for bits, name in zip(words, self.names(), strict=True)]
        return table.select(*keep, *packed)

    def _met(self, pairs: Sequence[tuple[str, object]]) -> list[Column]:
        """The bits of some values that an item has, for every number that holds one of them."""
        masks = zip(self.names(), self._masks(pairs), strict=True)
        return [F.col(name).bitwiseAND(F.lit(mask).cast("bigint")) for name, mask in masks if mask]

    def none_of(self, flags: Sequence[str]) -> Column:
        """No flag is set."""
        return reduce(lambda a, b: a & b, [met == 0 for met in self._met([(f, 1) for f in flags])], F.lit(True))

    def one_of(self, column: str, accepted: Sequence) -> Column:
        """The label is one of the accepted values."""
        return reduce(lambda a, b: a | b, [met != 0 for met in self._met([(column, v) for v in accepted])], F.lit(False))

    def matches(self, wanted: Mapping[str, object]) -> Column:
        """How many labels equal the wanted ones."""
        return reduce(lambda a, b: a + b, [F.bit_count(met) for met in self._met(list(wanted.items()))], F.lit(0))

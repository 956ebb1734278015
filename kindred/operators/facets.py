"""Facet filter: a parameter record compiled to one predicate the Parquet scan can take."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators.range_grid import QueryLimits

Range = tuple[float | None, float | None]


@dataclass(frozen=True)
class FacetFilter:
    """Filter parameters. A range of ``None`` is off; ``max_minutes=None`` is no limit."""

    methods: Sequence[str] = ()
    exclude: Sequence[str] = ()
    calories: Range | None = K.CALORIES_LIMITS
    protein: Range | None = K.PROTEIN_LIMITS
    fat: Range | None = K.FAT_LIMITS
    carbs: Range | None = K.CARBS_LIMITS
    max_minutes: float | None = None

    def predicate(self) -> Column:
        parts = [method_in(self.methods), excludes(self.exclude)]
        parts += [in_range(n, getattr(self, n)) for n in K.NUTRIENT_COLUMNS]
        parts.append(within_minutes(self.max_minutes))
        return reduce(lambda a, b: a & b, [p for p in parts if p is not None], F.lit(True))

    def candidates(self, facets: DataFrame) -> DataFrame:
        return facets.where(self.predicate()).select("item_id")


def method_in(methods: Sequence[str], column: str = "cooking_methods") -> Column | None:
    """Membership; no list, or ``Any`` in it, keeps everything."""
    if not methods or "Any" in methods:
        return None
    return F.col(column).isin(*methods)


def excludes(groups: Sequence[str]) -> Column | None:
    """Every chosen ingredient flag is 0; written so that the scan can evaluate it."""
    if not groups:
        return None
    unknown = [g for g in groups if g.lower() not in K.FLAG_COLUMNS]
    if unknown:
        raise ValueError(f"unknown ingredient groups: {unknown}")
    free = [(F.col(g.lower()) == 0) | F.col(g.lower()).isNull() for g in groups]
    return reduce(lambda a, b: a & b, free)


def in_range(column: str, limits: Range | None) -> Column | None:
    """Closed range; an open end is ``None``."""
    if limits is None:
        return None
    low, high = limits
    parts = []
    if low is not None:
        parts.append(F.col(column) >= low)
    if high is not None:
        parts.append(F.col(column) <= high)
    return reduce(lambda a, b: a & b, parts) if parts else None


def within_minutes(limit: float | None, column: str = "time_mins") -> Column | None:
    return None if limit is None else F.col(column) <= limit


# The same filter with one set of limits per query: columns of the query table.
QUERY_LIMITS = QueryLimits(
    ranges=(
        *((n, f"{n}_min", f"{n}_max") for n in K.NUTRIENT_COLUMNS),
        ("time_mins", None, "max_minutes"),
    ),
    method=("cooking_methods", "methods"),
    exclude=(tuple(K.FLAG_COLUMNS), "exclude"),
)


def with_limits(queries: DataFrame, default: FacetFilter = FacetFilter()) -> DataFrame:
    """Add the limit columns a query table does not bring along."""
    columns: dict[str, Column] = {
        "methods": F.lit(list(default.methods)).cast("array<string>"),
        "exclude": F.lit(list(default.exclude)).cast("array<string>"),
        "max_minutes": F.lit(default.max_minutes).cast("double"),
    }
    for name in K.NUTRIENT_COLUMNS:
        low, high = getattr(default, name) or (None, None)
        columns[f"{name}_min"] = F.lit(low).cast("double")
        columns[f"{name}_max"] = F.lit(high).cast("double")
    return queries.withColumns({c: e for c, e in columns.items() if c not in queries.columns})


def enough_candidates(candidates: DataFrame, least: int = K.MIN_CANDIDATES) -> bool:
    """True when at least ``least`` rows survive; reads no more than that."""
    return candidates.limit(least).count() >= least


def gate_by_group(rows: DataFrame, key: str, predicate: Column, least: int = K.MIN_CANDIDATES) -> DataFrame:
    """The gate for many queries at once: (key, candidates, status), groups without a candidate included."""
    return (
        rows.groupBy(key)
        .agg(F.count_if(predicate).alias("candidates"))
        .withColumn(
            "status", F.when(F.col("candidates") < least, "too_few_candidates").otherwise("ok")
        )
    )


def complete_query(*fields: str) -> Column:
    """All text fields are filled in."""
    return reduce(
        lambda a, b: a & b, [F.coalesce(F.length(f), F.lit(0)) > 0 for f in fields], F.lit(True)
    )


def request_status(k: Column, most: int, has_features: Column) -> Column:
    """Whether a search request can be run: ``ok``, or what is wrong with it."""
    return (
        F.when(k.isNull() | (k < K.USER_K_MIN) | (k > most), "k_out_of_range")
        .when(~F.coalesce(has_features, F.lit(False)), "no_filter_features").otherwise("ok")
    )


def facet_matches(features: dict[str, object] | None) -> Column:
    """Number of facets equal to the given values; NULL equals nothing."""
    if features is None:
        raise ValueError("filter_features cannot be None")
    one = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for c, v in features.items()]
    return reduce(lambda a, b: a + b, one, F.lit(0))


def no_nan(df: DataFrame, *columns: str) -> DataFrame:
    """NaN -> NULL at ingest; Spark orders and compares NaN as a value."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})

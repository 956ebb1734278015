"""Word-overlap search: shared words per field, summed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.scalars import set_to_text, text_to_set
from kindred.functions.tokens import kept_words, unique_words
from kindred.operators.dictionary import join_counted
from kindred.operators.scan import scan_topk
from kindred.operators.scorers import SparseScoring
from kindred.operators.topk import check_k, merge_topk, ranked
from kindred.shared import MAX_LOOKUP_ROWS
from kindred.sources.tables import write_csv

TEXT_FIELDS = ("directions", "ingr")
QUERY_FIELDS = ("directions", "ingredients")


def token_sets(
    rows: DataFrame,
    key: str,
    fields: Sequence[str],
    stop_words: Sequence[str] = K.STOP_WORDS,
    exceptions: Mapping[str, str] | None = None,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """(key, one token set per field). ``lemmas`` (surface, lemma) replaces the suffix rules."""
    if lemmas is None:
        sets = {f: unique_words(F.col(f), stop_words, exceptions) for f in fields}
        return rows.select(key, *[c.alias(f) for f, c in sets.items()])

    def surfaces(field: str) -> Column:
        words = F.coalesce(kept_words(F.col(field), stop_words), F.array().cast("array<string>"))
        return F.transform(words, lambda w: F.struct(F.lit(field).alias("field"), w.alias("surface")))

    words = F.array(*[surfaces(f) for f in fields])
    each = rows.select(key, F.explode_outer(F.flatten(words)).alias("w")).select(key, "w.*")
    if lemmas.limit(MAX_LOOKUP_ROWS + 1).count() <= MAX_LOOKUP_ROWS:
        found = each.join(F.broadcast(lemmas), "surface", "left")
    else:
        found = join_counted(each, lemmas, "surface", key)
    found = found.withColumn("lemma", F.coalesce("lemma", "surface"))
    return found.groupBy(key).agg(
        *[F.sort_array(F.collect_set(F.when(F.col("field") == f, F.col("lemma")))).alias(f) for f in fields]
    )


def as_features(sets: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One ``features`` array per row; the field number keeps fields apart."""

    def numbered(i: int, field: str) -> Column:
        words = F.coalesce(F.col(field), F.array().cast("array<string>"))
        return F.transform(words, lambda w: F.concat(F.lit(f"{i}:"), w))

    parts = [numbered(i, f) for i, f in enumerate(fields)]
    return sets.select(F.col(key), F.concat(*parts).alias("features"))


@dataclass(frozen=True)
class WordOverlapIndex:
    """Token sets of the corpus."""

    sets: DataFrame
    fields: tuple[str, ...] = TEXT_FIELDS

    @classmethod
    def fit(cls, items: DataFrame, fields: Sequence[str] = TEXT_FIELDS, **options) -> WordOverlapIndex:
        return cls(token_sets(items, "item_id", fields, **options), tuple(fields))

    def search(
        self, queries: DataFrame, k: int = K.DEFAULT_K, query_fields: Sequence[str] = QUERY_FIELDS,
        scan: Mapping | None = None, **options,
    ) -> DataFrame:
        """(query_id, rank, item_id, score); items without a shared word fill up at score 0."""
        wanted = token_sets(queries, "query_id", query_fields, **options)
        partials = scan_topk(
            as_features(self.sets, "item_id", self.fields),
            as_features(wanted, "query_id", query_fields),
            SparseScoring(weighted=False),
            check_k(k),
            **(scan or {}),
        )
        return ranked(merge_topk(partials, k)).withColumn("score", F.col("score").cast("bigint"))

    def write(self, path: str) -> None:
        self.sets.write.parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str, fields: Sequence[str] = TEXT_FIELDS) -> WordOverlapIndex:
        return cls(spark.read.parquet(path), tuple(fields))

    def write_csv(self, path: str) -> None:
        texts = self.sets.withColumns({f: set_to_text(F.col(f)) for f in self.fields})
        write_csv(texts, path)

    @classmethod
    def read_csv(cls, spark: SparkSession, path: str, fields: Sequence[str] = TEXT_FIELDS) -> WordOverlapIndex:
        ddl = "item_id bigint, " + ", ".join(f"{f} string" for f in fields)
        rows = spark.read.schema(ddl).option("header", True).csv(path)
        return cls(rows.withColumns({f: text_to_set(F.col(f)) for f in fields}), tuple(fields))

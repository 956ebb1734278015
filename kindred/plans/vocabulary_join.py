"""Vocabulary matches when the vocabulary is a table: joins instead of one expression per entry.

The plans with a short list (``functions/scalars.py``) build one ``when`` or one alternation per entry. Here the texts
are cut into the pieces an entry could equal, and the pieces are joined with the entries, so a vocabulary may be as large
as a table can be. Each distinct text is cut once. Which of several matches counts is decided per text: the
first entry for a category, the leftmost match and there the first entry for a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.scalars import string_array
from kindred.shared import stored

MAX_LENGTHS = 200  # different lengths of entries


def _lengths(vocabulary: DataFrame) -> Column:
    """The different numbers of characters that entries have."""
    found = [r[0] for r in vocabulary.select(F.length("name")).distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(found) > MAX_LENGTHS:
        raise ValueError(f"the entries have more than {MAX_LENGTHS} different lengths")
    return F.array(*map(F.lit, sorted(found))).cast("array<int>")


def first_category(rows: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """(key, category): the first entry of ``vocabulary`` (``pos, name``) that a text contains, else the string ``None``.

    Any part of the text counts, not only whole words: as many parts of it are looked up as it has characters, for
    each length an entry has.
    """
    texts = rows.select(F.col(text).alias("_text")).where("_text IS NOT NULL").distinct()
    sized = texts.select("_text", F.explode(_lengths(vocabulary)).alias("_size")).where(F.col("_size") <= F.length("_text"))
    starts = F.sequence(F.lit(1), F.length("_text") - F.col("_size") + 1)
    parts = sized.select("_text", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substr("_text", i, F.col("_size"))))).alias("name"))
    best = parts.join(vocabulary, "name").groupBy("_text").agg(F.min_by("name", "pos").alias("_best"))
    found = rows.select(key, F.col(text).alias("_text")).join(best, "_text", "left")
    return found.select(key, F.coalesce("_best", F.lit("None")).alias("category"))


def _spans(text: Column, longest: int) -> Column:
    """All parts of a text that begin and end at the edge of a word, none longer than the longest entry."""

    def is_word(i: Column) -> Column:
        # There is no character 0, but the function would give the first one for it.
        return (i > 0) & F.rlike(F.substr(text, i, F.lit(1)), F.lit(r"(?U)\w"))

    # Place i is an edge if the characters before and after it differ in being part of a word.
    edges = F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: is_word(i) != is_word(i + 1))

    def from_edge(start: Column) -> Column:
        ends = F.filter(edges, lambda end: (end > start) & (end - start <= longest))
        return F.transform(ends, lambda end: F.struct(start.alias("start"), end.alias("end"), F.substr(text, start + 1, end - start).alias("name")))

    return F.flatten(F.transform(edges, from_edge))


def _leftmost(matches: Column) -> Column:
    """Matches that do not overlap: the leftmost first, of those that start together the first entry."""
    nothing = F.array().cast("array<struct<start:int,pos:bigint,end:int,name:string>>")

    def take(chosen: Column, one: Column) -> Column:
        free = F.coalesce(F.element_at(chosen, F.lit(-1))["end"], F.lit(0)) <= one["start"]
        return F.when((F.size(chosen) == 0) | free, F.concat(chosen, F.array(one))).otherwise(chosen)

    return F.aggregate(F.sort_array(matches), nothing, take)


def _rest(text: Column, chosen: Column) -> Column:
    """What lies between the matches, trimmed, without empty parts."""
    starts = F.concat(F.array(F.lit(0)), F.transform(chosen, lambda m: m["end"]))
    ends = F.concat(F.transform(chosen, lambda m: m["start"]), F.array(F.length(text)))
    gaps = F.zip_with(starts, ends, lambda a, b: F.trim(F.substr(text, a + 1, b - a)))
    return F.filter(gaps, lambda part: part != "")


def split_by_vocabulary(rows: DataFrame, key: str, categories: str, vocabulary: DataFrame) -> DataFrame:
    """(key, parts): elements of an array cut at the entries of ``vocabulary`` (``pos, name``), matches and remainders joined sorted.

    The same pieces as :func:`kindred.functions.scalars.split_by_vocabulary` with the entries in the order of ``pos``.
    """
    longest = vocabulary.agg(F.max(F.length("name"))).first()[0] or 0
    each = rows.select(key, F.explode(categories).alias("_text"))
    texts = stored(each.select("_text").where("_text IS NOT NULL").distinct(), "texts")
    spans = texts.select("_text", F.explode(_spans(F.col("_text"), longest)).alias("_s")).select("_text", "_s.*")
    entry = F.struct(F.col("start"), F.col("pos").cast("bigint").alias("pos"), F.col("end"), F.col("name"))
    matches = spans.join(vocabulary, "name").groupBy("_text").agg(_leftmost(F.collect_list(entry)).alias("_chosen"))
    cut = matches.select("_text", F.concat(F.transform("_chosen", lambda m: m["name"]), _rest(F.col("_text"), F.col("_chosen"))).alias("_parts"))
    found = each.join(cut, "_text", "left").withColumn("_parts", F.coalesce("_parts", F.array("_text")))
    pieces = found.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("_parts"))).alias("_all"))
    whole = rows.select(key).join(pieces, key, "left")
    return whole.select(key, F.array_join(F.sort_array(F.coalesce("_all", string_array([]))), ", ").alias("parts"))

"""Feature tables from raw items: facets, encoded facets, texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.models import COOKING_CLASSIFIER, INGREDIENT_CLASSIFIER, Classifier, classify
from kindred.functions.scalars import (
    clean_categories,
    contains_flag,
    first_category,
    split_lines,
    time_to_minutes,
)
from kindred.operators.dictionary import encode_labels, join_dictionary
from kindred.operators.facets import no_nan
from kindred.operators.flags import flags_of_rows
from kindred.shared import stored

ClassifierFactory = Callable[[], Classifier]


def label_features(raw: DataFrame, strict_time: bool = False, lenient_time: bool = False) -> DataFrame:
    """Categories cleaned; meal, course, diet, health flag and minutes beside them. No shuffle."""
    cleaned = raw.withColumn("categories", clean_categories(F.col("categories")))
    category = F.col("categories")
    return cleaned.withColumns(
        {
            "meal": first_category(category, K.MEALS),
            "course": first_category(category, K.COURSES),
            "healthy": F.coalesce(contains_flag(category, "Healthy"), F.lit(0)),
            "special_nutrition": first_category(category, K.DIETS),
            "time_mins": time_to_minutes(F.col("total_time"), strict_time, lenient_time),
        }
    )


def ingredient_labels(
    lines: DataFrame,
    groups: Sequence[str] = K.INGREDIENT_GROUPS,
    factory: ClassifierFactory = INGREDIENT_CLASSIFIER,
    threshold: float = K.LABEL_CONFIDENCE,
) -> DataFrame:
    """(line, n, grp): each distinct line classified once; NULL group below the threshold."""
    distinct = lines.groupBy("line").agg(F.count("*").alias("n"))
    best = classify(F.col("line"), groups, factory)
    sure = F.when(F.col("best.score") > threshold, F.col("best.label"))
    return distinct.withColumn("best", best).select("line", "n", sure.alias("grp"))


def ingredient_flags(
    raw: DataFrame,
    groups: Sequence[str] = K.INGREDIENT_GROUPS,
    factory: ClassifierFactory = INGREDIENT_CLASSIFIER,
    threshold: float = K.LABEL_CONFIDENCE,
) -> DataFrame:
    """(item_id, one 0/1 flag per group); every item with ingredients is present."""
    lines = raw.select("item_id", F.explode(split_lines(F.col("ingr"))).alias("line"))
    labels = stored(ingredient_labels(lines, groups, factory, threshold), "ingredient-labels")
    total = labels.agg(F.sum("n")).first()[0] or 0
    # A staple such as salt may be a third of all lines: see join_dictionary.
    named = join_dictionary(lines, labels, "line", "n", total, "item_id")
    return flags_of_rows(named, "item_id", "grp", groups, [g.lower() for g in groups])


def build_facets(
    raw: DataFrame,
    cooking: ClassifierFactory = COOKING_CLASSIFIER,
    ingredients: ClassifierFactory = INGREDIENT_CLASSIFIER,
    **time_options: bool,
) -> DataFrame:
    """The facet table, one row per raw item, columns in their fixed order."""
    labelled = no_nan(label_features(raw, **time_options), *K.NUTRIENT_COLUMNS)
    method = classify(F.col("directions"), K.COOKING_METHODS, cooking)
    facets = labelled.withColumn("cooking_methods", method.getField("label"))
    flags = ingredient_flags(raw, factory=ingredients)
    joined = facets.join(flags, "item_id", "left").na.fill(0, K.FLAG_COLUMNS)
    return joined.select("item_id", *K.FACET_ORDER)


@dataclass(frozen=True)
class FeatureTables:
    facets: DataFrame
    facets_encoded: DataFrame
    label_dictionary: DataFrame
    items_text: DataFrame


def build_features(raw: DataFrame, **options) -> FeatureTables:
    """All tables of the feature build. Facets are stored once: codes and readers share them."""
    facets = stored(build_facets(raw, **options), "facets")
    encoded, dictionary = encode_labels(facets, K.LABEL_COLUMNS)
    texts = raw.select("item_id", "directions", "ingr", "url")
    return FeatureTables(facets, encoded, dictionary, texts)

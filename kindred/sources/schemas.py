"""Declared schemas. Nothing is inferred from data."""

from kindred import constants as K

# Raw CSV header -> our column name. The headers of the exported files.
RAW_COLUMNS = {
    "Categories": "categories", "Calories": "calories", "Fat": "fat", "Carbs": "carbs",
    "Protein": "protein", "Total Time": "total_time", "Directions": "directions",
    "Ingr": "ingr", "URL": "url",
}
FACET_HEADERS = {
    "Calories": "calories", "Protein": "protein", "Fat": "fat", "Carbs": "carbs",
    "Meal": "meal", "Course": "course", "Healthy": "healthy",
    "Special Nutrition": "special_nutrition", "Cooking Methods": "cooking_methods",
    "time, mins": "time_mins",
    **{g: g.lower() for g in K.INGREDIENT_GROUPS},
}
TEXT_HEADERS = {"Directions": "directions", "Ingr": "ingr", "URL": "url"}

_TYPES = {
    **dict.fromkeys(K.NUTRIENT_COLUMNS, "double"),
    **dict.fromkeys(["healthy", "time_mins", *K.FLAG_COLUMNS], "int"),
}


def types_of(labels_as_codes: bool = False) -> dict[str, str]:
    """Column types that are not string."""
    codes = dict.fromkeys(K.LABEL_COLUMNS, "int") if labels_as_codes else {}
    return {**_TYPES, **codes}


def ddl(columns, labels_as_codes: bool = False) -> str:
    """DDL of a table with ``item_id`` and the given columns."""
    types = types_of(labels_as_codes)
    return ", ".join(["item_id bigint", *(f"{c} {types.get(c, 'string')}" for c in columns)])


FACETS = ddl(K.FACET_ORDER)
FACETS_ENCODED = ddl(K.FACET_ORDER, labels_as_codes=True)
ITEMS_TEXT = ddl(TEXT_HEADERS.values())
ITEMS_RAW = ddl(RAW_COLUMNS.values())
EMBEDDINGS = "item_id bigint, embedding array<float>"
GOLDEN = "query_id bigint, relevant_id bigint"

import pytest
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions import scalars


@pytest.mark.parametrize(
    ("text", "names", "expected"),
    [
        ("a red barn", ["blue", "red"], "red"),
        ("red and blue", ["blue", "red"], "blue"),  # the order of the names decides, not that of the text
        ("Red barn", ["red"], "None"),  # letter case counts
        ("bluebell", ["blue"], "blue"),  # a part of a word will do
        ("", ["red"], "None"),
        (None, ["red"], "None"),
    ],
)
def test_first_category(value, text, names, expected):
    assert value(lambda c: scalars.first_category(c, names), text) == expected


@pytest.mark.parametrize("names", [K.MEALS, K.COURSES, K.DIETS])
def test_first_category_finds_every_name(value, names):
    for name in names:
        first = next(n for n in names if n in name)
        assert value(lambda c: scalars.first_category(c, names), f"x{name}x") == first


@pytest.mark.parametrize(
    ("text", "minutes"),
    [
        ("7 hrs 4 mins", 424),
        ("07 hr 04 min", 424),
        ("7H 4M", 424),
        ("7h\t 4 min", 424),
        ("23 hrs 59 mins", 1439),
        ("0 hrs 0 mins", 0),
        ("24 hrs 0 mins", None),
        ("7 hrs 60 mins", None),
        ("7 hrs4 mins", None),
        ("7  hrs 4 mins", None),
        ("7 hours 4 mins", None),
        ("4 mins 7 hrs", None),
        (" 7 hrs 4 mins", None),
        ("7 hrs 4 mins\n", None),
        ("107 hrs 4 mins", None),
        ("7 hrs", None),
        ("", None),
        (None, None),
    ],
)
def test_time_to_minutes(value, text, minutes):
    assert value(scalars.time_to_minutes, text) == minutes
    assert value(scalars.unreadable_time, text) == (minutes is None and text is not None)


def test_time_lenient_and_strict(value):
    assert value(lambda c: scalars.time_to_minutes(c, lenient=True), "8 mins") == 8
    assert value(lambda c: scalars.time_to_minutes(c, lenient=True), "3 hrs") == 180
    assert value(lambda c: scalars.time_to_minutes(c, strict=True), "3 hrs 8 mins") == 188
    with pytest.raises(Exception, match="not a duration"):
        value(lambda c: scalars.time_to_minutes(c, strict=True), "8 mins")


def test_time_round_trip(spark):
    rows = spark.range(24 * 60).select(
        F.col("id").cast("int"),
        F.format_string("%d hrs %d mins", F.floor(F.col("id") / 60), F.col("id") % 60).alias("t"),
    )
    wrong = rows.where(~scalars.time_to_minutes(F.col("t")).eqNullSafe(F.col("id")))
    assert wrong.count() == 0


@pytest.mark.parametrize(
    ("word", "expected"),
    [
        ("Recipes", "Recipe"), ("Dishes", "Dish"), ("Cookies", "Cookie"), ("pies", "pie"),
        ("berries", "berry"), ("tomatoes", "tomato"), ("potatoes", "potato"), ("molasses", "molasses"),
        ("glass", "glass"), ("asparagus", "asparagus"), ("Leaves", "Leaf"), ("s", "s"), ("as", "as"),
        ("boxes", "box"), ("Men", "Man"), ("apple", "apple"), ("children", "child"),
    ],
)
def test_singular(value, word, expected):
    assert value(scalars.singular, word) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("plum and pear, fig, plum", {"plum", "pear", "fig"}),
        ("Recipes", set()),
        ("Fig Recipes and figs", {"Fig", "fig"}),
        ("hot, stew, hot stew, cold stew", {"hot", "stew", "cold stew"}),
        ("  Dinner \t Recipes ,Side\n Dishes", {"Dinner", "Side Dish"}),
        ("a and and b", {"a", "and b"}),
        ("Sand Andes", {"Sand Ande"}),
        (",", set()),
    ],
)
def test_normalize_and_drop_combined(value, text, expected):
    cleaned = value(lambda c: scalars.drop_combined(scalars.normalize_categories(c)), text)
    assert set(cleaned) == expected and len(cleaned) == len(expected)


def test_drop_combined_needs_two_different_members(spark):
    frame = spark.createDataFrame([(["a", "a a", "b", "b a b", "b a"],)], "c array<string>")
    kept = frame.select(scalars.drop_combined(F.col("c")).alias("c")).first()["c"]
    # "a a" would need "a" twice; "b a b" is "b a" + "b"; "b a" is "b" + "a".
    assert kept == ["a", "a a", "b"]


def _drop_combined_by_pairs(members):
    pairs = {f"{a} {b}" for a in members for b in members if a != b}
    return [m for m in members if m not in pairs]


def test_drop_combined_equals_all_pairs(spark):
    import itertools

    words = ["a", "b", "a b", "b a", "a b a", "b b"]
    cases = [list(c) for n in range(4) for c in itertools.combinations(words, n)]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c array<string>")
    rows = frame.select("i", scalars.drop_combined(F.col("c")).alias("k")).collect()
    assert {r["i"]: r["k"] for r in rows} == {i: _drop_combined_by_pairs(c) for i, c in enumerate(cases)}


def test_split_by_vocabulary(spark):
    frame = spark.createDataFrame([(["Easy Main Dish Ideas", "Soup", "Pasta Salad", "Salads", "BBQ & Grilled Beef"],)], "c array<string>")
    out = frame.select(scalars.split_by_vocabulary(F.col("c")).alias("c")).first()["c"]
    assert out == "BBQ & Grilled, Beef, Easy, Ideas, Main Dish, Pasta, Salad, Salads, Soup"


def test_clean_categories(value):
    assert value(scalars.clean_categories, "Healthy Soup Recipes, Main Dishes and Vegan") == "Healthy, Main Dish, Soup, Vegan"


def test_token_text_round_trip(spark):
    frame = spark.createDataFrame([(0, ["b", "a"]), (1, ["one"]), (2, [])], "i int, s array<string>")
    text = frame.select("i", scalars.set_to_text(F.col("s")).alias("t"))
    back = text.select("i", scalars.text_to_set(F.col("t")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in back] == [["a", "b"], ["one"], []]


def test_split_lines(value):
    assert value(scalars.split_lines, "1 cup flour, sifted,  2 eggs") == ["1 cup flour, sifted", "2 eggs"]


def test_max_minutes():
    assert scalars.max_minutes(1, 30) == 90

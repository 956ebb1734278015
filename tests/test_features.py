import random

import pytest
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions import models
from kindred.operators import dictionary
from kindred.operators.dictionary import encode_labels, join_dictionary, label_dictionary, numbered
from kindred.operators.flags import flags_of_array, flags_of_rows
from kindred.plans import feature_build


def test_flags(spark):
    rows = spark.createDataFrame([("x", ["tin", "tin"]), ("y", ["sand", "moss", "tin"]), ("z", None)], "name string, g array<string>")
    names = ["moss", "tin"]
    out = rows.select("name", *[c.alias(n) for n, c in flags_of_array(F.col("g"), names, names).items()])
    want = {("x", 0, 1), ("y", 1, 1), ("z", 0, 0)}
    assert set(map(tuple, out.collect())) == want
    long = rows.select("name", F.explode_outer("g").alias("g"))
    assert set(map(tuple, flags_of_rows(long, "name", "g", names, names).collect())) == want


@pytest.mark.parametrize("small", [1000, 0])
def test_label_codes(spark, small):
    """Codes by sorted label per column; the way for large dictionaries gives the same."""
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["b", "a", "É", "Z", "aa"]), rnd.choice(["x", "y", None])) for i in range(60)]
    frame = spark.createDataFrame(rows, "item_id long, one string, two string").repartition(3)
    encoded, labels = encode_labels(frame, ["one", "two"], small=small)
    code = {}
    for column, at in (("one", 1), ("two", 2)):
        known = sorted({r[at] for r in rows if r[at] is not None}, key=lambda s: s.encode())
        code[column] = {v: i for i, v in enumerate(known)}
    want = {(i, code["one"][a], code["two"].get(b)) for i, a, b in rows}
    assert set(map(tuple, encoded.collect())) == want
    assert {(r["column"], r["label"]): r["code"] for r in labels.collect()} == {
        (c, v): n for c, m in code.items() for v, n in m.items()
    }


def test_numbered_over_many_partitions(spark):
    values = spark.range(5000).select(F.format_string("k%05d", F.col("id")).alias("v")).repartition(7)
    rows = numbered(values, "v").orderBy("v").collect()
    assert [r["code"] for r in rows] == list(range(5000))


@pytest.mark.parametrize("share", [1, 3, 10_000])
def test_join_dictionary(spark, monkeypatch, share):
    monkeypatch.setattr(dictionary, "HOT_SHARE", share)
    keys = ["salt"] * 50 + ["egg"] * 5 + ["rare", None, "unknown"]
    rows = spark.createDataFrame(list(enumerate(keys)), "item_id long, line string")
    known = spark.createDataFrame([("salt", 50, "Grains"), ("egg", 5, "Dairy"), ("rare", 1, None)], "line string, n long, grp string")
    group = {"salt": "Grains", "egg": "Dairy"}
    out = join_dictionary(rows, known, "line", "n", 56, "item_id")
    got = {r["item_id"]: r["grp"] for r in out.collect()}
    assert got == {i: group.get(k) for i, k in enumerate(keys)}


def test_spread_stays_a_join_key(spark):
    """The optimiser must not fold it away, or hot keys would meet in one task again."""
    rows = spark.createDataFrame([(1, "a")], "item_id long, line string")
    known = spark.createDataFrame([("a", 1, "x")], "line string, n long, grp string").hint("merge")
    plan = join_dictionary(rows, known, "line", "n", 1, "item_id")._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line or "HashJoin" in line]
    assert any("spread" in line.split("LeftOuter")[0] for line in joins), plan


def test_encoder_and_classifier_defaults():
    encode = models.hashing_encoder(8)
    a, b, empty = encode(["Bake the pie", "bake THE pie", ""])
    assert a.tolist() == b.tolist() and abs((a * a).sum() - 1) < 1e-12 and not empty.any()
    classify = models.lexicon_classifier({"A": ["x", "y"], "B": ["z"]})
    assert classify(["x z x", "none", "z", ""], ["A", "B"]) == [("A", 2 / 3), ("A", 0.5), ("B", 1.0), ("A", 0.5)]


def test_classifier_batches(spark):
    def factory():
        def run(texts, labels):
            assert len(texts) <= 4
            return [(labels[0], float(len(texts)))] * len(texts)
        return run

    frame = spark.range(10).select(F.col("id").cast("string").alias("t")).coalesce(1)
    rows = frame.select(models.classify(F.col("t"), ["only"], factory, 4).alias("r")).select("r.*").collect()
    assert sorted(r["score"] for r in rows) == [2.0, 2.0] + [4.0] * 8


RAW = [
    # item, categories, calories, fat, carbs, protein, time, directions, ingredients
    (0, "Healthy Soup Recipes, Main Dishes and Vegan", 120.0, 1.0, 2.0, 3.0, "1 hr 30 mins", "Boil and simmer", "1 onion,  salt"),
    (1, "Dinner Recipes", float("nan"), 1.0, 2.0, 3.0, "45 mins", "Bake in the oven", "fish fillet,  1 cup milk,  salt"),
    (2, "Cookies", None, 1.0, 2.0, 3.0, None, "", "salt"),
    (3, None, 5.0, 1.0, 2.0, 3.0, "2 hrs 5 mins", None, None),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [(*r, f"u{r[0]}") for r in RAW],
        "item_id long, categories string, calories double, fat double, carbs double, protein double,"
        " total_time string, directions string, ingr string, url string",
    )


def test_build_features(raw):
    tables = feature_build.build_features(raw)
    assert tables.facets.columns == ["item_id", *K.FACET_ORDER]
    rows = {r["item_id"]: r for r in tables.facets.collect()}
    assert len(rows) == 4
    first = rows[0]
    assert (first["meal"], first["course"], first["healthy"], first["special_nutrition"]) == ("None", "Soup", 1, "Vegan")
    assert (first["time_mins"], first["cooking_methods"], first["vegetables"], first["seafood"]) == (90, "Boiling", 1, 0)
    assert rows[1]["calories"] is None and rows[2]["calories"] is None
    assert (rows[1]["meal"], rows[1]["time_mins"]) == ("Dinner", None)
    assert [rows[1][c] for c in K.FLAG_COLUMNS] == [0, 0, 0, 1, 0, 1, 0, 0]
    # Without a group, or without ingredients, every flag is 0, seafood included.
    assert all(rows[i][c] == 0 for i in (2, 3) for c in K.FLAG_COLUMNS)
    codes = {r["item_id"]: r for r in tables.facets_encoded.collect()}
    assert [codes[i]["meal"] for i in range(4)] == [1, 0, 1, 1]
    assert tables.items_text.columns == ["item_id", "directions", "ingr", "url"]
    assert {(r["column"], r["label"]) for r in tables.label_dictionary.collect()} >= {("meal", "Dinner"), ("course", "Soup")}


def test_each_line_is_classified_once(raw, spark):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def run(texts, labels):
            seen.add(len(texts))
            return [(labels[0], 0.7 if t == "salt" else 0.6) for t in texts]
        return run

    flags = feature_build.ingredient_flags(raw, factory=factory)
    rows = {r["item_id"]: r["vegetables"] for r in flags.collect()}
    assert rows == {0: 1, 1: 1, 2: 1}  # 0.6 itself is not enough, 0.7 is
    assert seen.value == 4


def test_strict_time(raw):
    with pytest.raises(Exception, match="not a duration"):
        feature_build.label_features(raw, strict_time=True).select("time_mins").collect()
    lenient = feature_build.label_features(raw, lenient_time=True).orderBy("item_id").collect()
    assert [r["time_mins"] for r in lenient] == [90, 45, None, 125]


def test_label_count_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "item_id long, one string")
    assert label_dictionary(empty, ["one"]).count() == 0

"""Vocabularies and labels as tables, alignment by position, cells that cannot be read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions import models, scalars
from kindred.operators import facets
from kindred.plans import vocabulary_join
from kindred.plans.label_store import LabelStore
from kindred.sources import positions, schemas, tables

VOCABULARY = ["red", "gear", "Brand", "ring", "old rod", "old", "BBQ & Grilled", "é-x", "ünder", "a b", "b c"]
TEXTS = [
    "red gear", "gold rod", "old rod and old", "BBQ & Grilled Dinner", "café é-x", "wünder ünder", "a b c", "b c a b", "", "  ", None, "ringing ring",
    "Brand#17", "x", "red", "REDred red", "old rodold rod", "old rod_old rod", " red ",
]


def vocabulary(spark, names=VOCABULARY):
    return spark.createDataFrame(list(enumerate(names)), "pos long, name string")


def test_first_category_of_a_table(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)) + [(len(TEXTS), TEXTS[0])], "id long, text string")
    got = vocabulary_join.first_category(rows, "id", "text", vocabulary(spark))
    want = rows.select("id", scalars.first_category(F.col("text"), VOCABULARY).alias("category"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.category for r in vocabulary_join.first_category(rows, "id", "text", vocabulary(spark).limit(0)).collect()} == {"None"}


def test_split_by_a_table(spark):
    lists = [[t] for t in TEXTS if t is not None] + [["red gear", "old", "red gear"], [], ["a b c", "b c"], TEXTS[:8]]
    rows = spark.createDataFrame(list(enumerate(lists)), "id long, names array<string>")
    for names in (VOCABULARY, VOCABULARY[::-1]):
        got = vocabulary_join.split_by_vocabulary(rows, "id", "names", vocabulary(spark, names))
        want = rows.select("id", scalars.split_by_vocabulary(F.col("names"), names).alias("parts"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_alignment_by_position(spark, tmp_path):
    left = spark.range(1000).select(F.col("id").alias("a")).repartitionByRange(9, "a").sortWithinPartitions("a")
    right = spark.range(1000).select((F.col("id") * 2).alias("b")).repartitionByRange(4, "b").sortWithinPartitions("b")
    left.write.parquet(str(tmp_path / "left"))
    right.write.parquet(str(tmp_path / "right"))
    both = [spark.read.parquet(str(tmp_path / n)) for n in ("left", "right")]
    assert len(both[0].inputFiles()) == 9 and len(both[1].inputFiles()) == 4
    found = positions.align(*both).orderBy("pos").collect()
    assert [tuple(r) for r in found] == [(i, i, 2 * i) for i in range(1000)]
    right.limit(999).write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="1000 and 999 rows"):
        positions.align(both[0], spark.read.parquet(str(tmp_path / "short")))


def test_a_line_is_classified_once(spark, tmp_path):
    sent = str(tmp_path / "sent")

    def factory():
        def classify(lines, labels):
            with open(sent, "a") as out:
                out.writelines(f"{line}\n" for line in lines)
            return [("Meat" if "beef" in line else labels[0], 0.9 if line else 0.1) for line in lines]

        return classify

    store = LabelStore(spark, str(tmp_path / "labels"))
    first = spark.createDataFrame([(1, "beef"), (1, "salt"), (2, "salt"), (2, ""), (3, None)], "item_id long, line string")
    second = first.union(spark.createDataFrame([(4, "beef stew"), (4, "salt")], "item_id long, line string"))
    store.add(first.select("line"), factory=factory)
    store.add(second.select("line"), factory=factory)
    store.add(second.select("line"), factory=factory)
    with open(sent) as lines:
        assert sorted(line.rstrip("\n") for line in lines) == ["", "beef", "beef stew", "salt"]
    got = sorted((r.item_id, str(r.line), str(r.grp)) for r in store.labelled(second, "item_id").collect())
    group = K.INGREDIENT_GROUPS[0]
    assert got == [(1, "beef", "Meat"), (1, "salt", group), (2, "", "None"), (2, "salt", group), (3, "None", "None"), (4, "beef stew", "Meat"), (4, "salt", group)]
    assert store.labels().select("batch").distinct().count() <= 3


def test_lexicon_columns_equal_the_classifier(spark):
    lexicon = {"A": ["beef", "pork"], "B": ["salt", "beef"], "C": []}
    labels = ["C", "A", "B", "D"]
    lines = ["", None, "beef", "salt and pork", "salt salt pork", "Beef_steak BEEF", "naïve Salt's", "123 pork-salt"]
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = frame.select("id", models.lexicon_label(F.col("line"), lexicon, labels).alias("b")).orderBy("id").collect()
    want = models.lexicon_classifier(lexicon)([x or "" for x in lines], labels)
    assert [r.b.label for r in got] == [label for label, _ in want]
    np.testing.assert_allclose([r.b.score for r in got], [score for _, score in want])


def test_unreadable_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,Calories,Meal,"time, mins"\n1,12.5,Lunch,30\n2,lots,7,3.5\n3,,Dinner,\n4,1e3,,x\n')
    headers = {"Calories": "calories", "Meal": "meal", "time, mins": "time_mins"}
    found = tables.unreadable_cells(spark, str(tmp_path / "f.csv"), headers)
    assert sorted(map(tuple, found.collect())) == [("calories", 1, 4), ("time_mins", 2, 4)]
    coded = tables.unreadable_cells(spark, str(tmp_path / "f.csv"), headers, labels_as_codes=True)
    assert ("meal", 2, 4) in list(map(tuple, coded.collect()))
    read = tables.read_csv(spark, str(tmp_path / "f.csv"), headers, key="id")
    assert read.where("calories IS NULL").count() == 2  # one empty, one unreadable


def test_request_status(spark):
    frame = spark.createDataFrame([(1, True), (0, True), (50, False), (51, True), (None, True), (5, None)], "k int, has boolean")
    got = frame.select(facets.request_status(F.col("k"), K.USER_K_MAX, F.col("has"))).collect()
    assert [r[0] for r in got] == ["ok", "k_out_of_range", "no_filter_features", "k_out_of_range", "k_out_of_range", "no_filter_features"]


def test_catalogue_places(spark, tmp_path):
    places = tables.Catalogue(str(tmp_path))
    rows = spark.createDataFrame([(1, 2.0)], "item_id long, calories double")
    tables.write_table(rows, places.facets)
    assert tables.read_table(spark, places.facets, "item_id long, calories double").collect() == rows.collect()
    assert len({places.items_raw, places.facets, places.facets_encoded, places.label_dictionary, places.items_text, places.index("words")}) == 6
    assert schemas.FACETS_ENCODED.count(" int") > schemas.FACETS.count(" int")

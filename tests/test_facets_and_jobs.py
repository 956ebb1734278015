import json

import pytest
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators import facets
from kindred.operators.facets import FacetFilter
from kindred.plans import evaluation
from kindred.plans.feature_build import label_features
from kindred.plans.filtered_search import filtered_search, search_with_filter
from kindred.plans.vector_search import EmbeddingIndex
from kindred.sources import schemas, tables
from kindred.streaming.search import answer_stream

BASE = {"calories": 100.0, "protein": 10.0, "fat": 5.0, "carbs": 20.0, "cooking_methods": "Baking", "time_mins": 30,
        **dict.fromkeys(K.FLAG_COLUMNS, 0)}


def facet_table(spark, *changes):
    schema = ("item_id long, calories double, protein double, fat double, carbs double, cooking_methods string,"
              " time_mins int, " + ", ".join(f"{c} int" for c in K.FLAG_COLUMNS))
    names = [p.split()[0] for p in schema.split(", ")]
    rows = [tuple({**BASE, **c, "item_id": i}[n] for n in names) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, schema)


CHANGES = [
    {}, {"calories": 1000.0}, {"calories": 1000.5}, {"calories": None}, {"protein": 40.0}, {"protein": 41.0},
    {"fat": 51.0}, {"carbs": 100.0}, {"carbs": -1.0}, {"cooking_methods": "Frying"}, {"cooking_methods": None},
    {"time_mins": 0}, {"time_mins": None}, {"seafood": 1}, {"nuts": 1, "meat": 1}, {"seafood": None},
]
CASES = [
    (FacetFilter(), [0, 1, 4, 7, 9, 10, 11, 12, 13, 14, 15]),
    (FacetFilter(calories=None, protein=None, fat=None, carbs=None), list(range(16))),
    (FacetFilter(calories=(None, 100), fat=(5, None)), [0, 4, 6, 7, 9, 10, 11, 12, 13, 14, 15]),
    (FacetFilter(methods=["Frying"]), [9]),
    (FacetFilter(methods=["Frying", "Any"]), [0, 1, 4, 7, 9, 10, 11, 12, 13, 14, 15]),
    (FacetFilter(exclude=["Seafood"]), [0, 1, 4, 7, 9, 10, 11, 12, 14, 15]),
    (FacetFilter(exclude=["Nuts", "Seafood"]), [0, 1, 4, 7, 9, 10, 11, 12, 15]),
    (FacetFilter(max_minutes=0), [11]),
    (FacetFilter(max_minutes=30), [0, 1, 4, 7, 9, 10, 11, 13, 14, 15]),
]


@pytest.mark.parametrize(("chosen", "expected"), CASES)
def test_filter(spark, chosen, expected):
    kept = chosen.candidates(facet_table(spark, *CHANGES)).orderBy("item_id").collect()
    assert [r["item_id"] for r in kept] == expected


def test_filter_per_query_equals_shared_filter(spark):
    """All filters at once as columns of the query table."""
    items = facet_table(spark, *CHANGES).withColumn("embedding", F.array(F.lit(1.0), F.col("item_id") / 100))
    rows = []
    for q, (f, _) in enumerate(CASES):
        ends = [e for n in K.NUTRIENT_COLUMNS for e in (getattr(f, n) or (None, None))]
        rows.append((q, [1.0, 0.0], list(f.methods), list(f.exclude), None if f.max_minutes is None else float(f.max_minutes),
                     *[None if e is None else float(e) for e in ends]))
    limits = ", ".join(f"{n}_min double, {n}_max double" for n in K.NUTRIENT_COLUMNS)
    asked = spark.createDataFrame(rows, "query_id long, embedding array<double>, methods array<string>,"
                                        f" exclude array<string>, max_minutes double, {limits}")
    urls = items.select("item_id", F.concat(F.lit("u"), "item_id").alias("url"))
    found = filtered_search(asked, EmbeddingIndex(items), urls, 50, 1, demote=2.0).collect()
    for q, (_, expected) in enumerate(CASES):
        assert sorted(r["item_id"] for r in found if r["query_id"] == q) == expected


def test_unknown_group_is_an_error():
    with pytest.raises(ValueError, match="unknown ingredient groups"):
        FacetFilter(exclude=["Plutonium"]).predicate()


def test_filter_reaches_the_scan(spark, tmp_path):
    facet_table(spark, *CHANGES).write.parquet(str(tmp_path / "facets"))
    chosen = FacetFilter(methods=["Baking"], exclude=["Nuts"], max_minutes=60)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = chosen.candidates(spark.read.parquet(str(tmp_path / "facets")))._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters: [") :].split("]")[0]
    for part in ("GreaterThanOrEqual(calories", "LessThanOrEqual(carbs", "LessThanOrEqual(time_mins", "cooking_methods", "EqualTo(nuts"):
        assert part in pushed


def test_gate(spark):
    table = spark.range(120).select((F.col("id") >= 100).cast("int").alias("key"))
    assert facets.enough_candidates(table) and not facets.enough_candidates(table.where("key = 1"))
    rows = {r["key"]: (r["candidates"], r["status"]) for r in facets.gate_by_group(table, "key", F.lit(True)).collect()}
    assert rows == {0: (100, "ok"), 1: (20, "too_few_candidates")}
    strict = facets.gate_by_group(table, "key", F.col("key") == 0).collect()
    assert {r["key"]: (r["candidates"], r["status"]) for r in strict} == {0: (100, "ok"), 1: (0, "too_few_candidates")}


@pytest.mark.parametrize(
    ("row", "wanted", "expected"),
    [
        ((7, "tin", 1), (7, "tin"), 2),
        ((7, "tin", 1), (8, "tin"), 1),
        ((7, "tin", 1), (8, "Tin"), 0),
        ((None, "tin", 1), (7, "tin"), 1),
        ((None, None, None), (7, "tin"), 0),
    ],
)
def test_facet_matches(spark, row, wanted, expected):
    frame = spark.createDataFrame([row], "size int, metal string, other int")
    features = dict(zip(["size", "metal"], wanted, strict=True))
    assert frame.select(facets.facet_matches(features).alias("n")).first()["n"] == expected


def test_facet_matches_needs_features():
    with pytest.raises(ValueError, match="filter_features cannot be None"):
        facets.facet_matches(None)


# ------------------------------------------------------------------ search jobs


@pytest.fixture(scope="module")
def shop(spark):
    items = facet_table(spark, *[{"calories": float(i)} for i in range(150)])
    table = items.withColumn("embedding", F.array(F.lit(1.0), F.col("item_id") / 100))
    urls = items.select("item_id", F.concat(F.lit("u"), "item_id").alias("url"))
    return items, EmbeddingIndex(table), urls


def test_filtered_search(spark, shop):
    _, index, urls = shop
    asked = spark.createDataFrame(
        [(1, "bake", "flour", [1.0, 0.0], 149.0), (2, "bake", "", [1.0, 0.0], 149.0),
         (3, "bake", "flour", [1.0, 0.0], 98.0), (4, "bake", "flour", [1.0, 0.0], 99.0), (5, None, "x", [1.0, 0.0], 9.0)],
        "query_id long, directions string, ingredients string, embedding array<double>, calories_max double",
    ).withColumn("calories_min", F.lit(0.0))
    rows = filtered_search(asked, index, urls, 2).orderBy("query_id", "rank").collect()
    got = [(r["query_id"], r["status"], r["rank"], r["url"]) for r in rows]
    # Items below a cosine of 0.98 come first: the nearest ones are taken for duplicates.
    assert got == [
        (1, "ok", 1, "u21"), (1, "ok", 2, "u22"),
        (2, "incomplete_query", None, None),
        (3, "too_few_candidates", None, None),
        (4, "ok", 1, "u21"), (4, "ok", 2, "u22"),
        (5, "incomplete_query", None, None),
    ]


def test_filtered_search_stores_no_pairs(spark, shop, monkeypatch):
    """All items are candidates of all queries, and yet what is stored stays within queries and lists."""
    from kindred.plans import filtered_search as module

    sizes, stored = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: (out := stored(df, name), sizes.append(out.count()))[0])
    _, index, urls = shop
    asked = spark.range(30).selectExpr("id AS query_id", "'bake' AS directions", "'flour' AS ingredients", "array(1.0D, id / 50) AS embedding")
    found = filtered_search(asked, index, urls, 2)
    assert found.where("status = 'ok'").count() == 60
    assert max(sizes) <= 30 * 2 * 2 * spark.sparkContext.defaultParallelism


def test_filtered_search_with_repeated_rows(spark, shop):
    """A query that stands twice has twice the candidates, and meets each of them four times."""
    _, index, urls = shop
    kind = "query_id long, directions string, ingredients string, embedding array<double>, calories_max double"
    asked = spark.createDataFrame([(1, "bake", "flour", [1.0, 0.0], 49.0)] * 2 + [(None, "bake", "flour", [1.0, 0.0], 149.0)], kind)
    found = filtered_search(asked.withColumn("calories_min", F.lit(0.0)), index, urls, 5).collect()
    got = sorted((r["rank"], r["url"]) for r in found if r["status"] == "ok")
    assert got == [(1, "u21"), (2, "u21"), (3, "u21"), (4, "u21"), (5, "u22")]
    assert [r["query_id"] for r in found if r["status"] != "ok"] == [None]


def test_shared_filter_both_layouts(spark, shop):
    items, index, urls = shop
    asked = spark.createDataFrame([(1, "bake", "flour", [1.0, 0.0])],
                                  "query_id long, directions string, ingredients string, embedding array<double>")
    chosen = FacetFilter(calories=(30, 140))
    bare = EmbeddingIndex(index.vectors.select("item_id", "embedding"))
    for found in (search_with_filter(asked, index, chosen, urls, 3),
                  search_with_filter(asked, bare, chosen, urls, 3, facets=items)):
        assert [r["url"] for r in found.orderBy("rank").collect()] == ["u30", "u31", "u32"]
    strict = search_with_filter(asked, index, FacetFilter(calories=(0, 98)), urls, 3).collect()
    assert {r["status"] for r in strict} == {"too_few_candidates"} and len(strict) == asked.count()
    unlinked = search_with_filter(asked, index, chosen, urls.where("item_id <> 31"), 3).orderBy("rank").collect()
    assert [r["url"] for r in unlinked] == ["u30", None, "u32"]
    with pytest.raises(ValueError, match="k must be"):
        search_with_filter(asked, index, chosen, urls, 51, k_max=50)


def test_evaluation(spark):
    golden = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 2), (2, 20)], "query_id long, relevant_id long")
    def predicted(*rows):
        return spark.createDataFrame([(q, n, i, 0.0) for n, (q, i) in enumerate(rows)], "query_id long, rank int, item_id long, score double")
    predictions = {"a": predicted((1, 10), (1, 12), (2, 2), (3, 10)), "b": predicted((1, 10), (2, 11)), "c": predicted()}
    rows = {r["method"]: (r["hits"], r["max_hits"], r["hit_pct"]) for r in evaluation.hit_report(predictions, golden).collect()}
    assert rows == {"a": (2, 4, 50.0), "b": (1, 4, 25.0), "c": (0, 4, 0.0)}
    texts = spark.createDataFrame([(i, "d", "g", f"u{i}") for i in (1, 2, 10, 11, 12, 20)], "item_id long, directions string, ingr string, url string")
    listing = evaluation.evaluation_listing(predictions, golden, texts).collect()
    assert {(r["query_id"], r["url"]) for r in listing if r["source"] == "golden"} == {(1, "u10"), (1, "u11"), (2, "u2"), (2, "u20")}
    assert {r["url"] for r in listing if r["source"] == "request"} == {"u1", "u2"}
    assert sum(r["source"] == "a" for r in listing) == 4
    asked = evaluation.queries_from_items(texts, golden).collect()
    assert sorted(r["query_id"] for r in asked) == [1, 2]


# ------------------------------------------------------------------ sources, streams


def test_csv_import_and_export(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    head = "Categories,Calories,Fat,Carbs,Protein,Total Time,Directions,Ingr,URL\n"
    (files / "a.csv").write_text(head + '"Soup, Vegan",1.5,2,3,4,1 hr 30 mins,"say ""hi""\nthen stir","a,  b",u0\nx,,2,3,4,t,d,i,u1\n')
    (files / "b.csv").write_text(head + "y,9,2,3,4,t,d,i,u2\n")
    raw = tables.read_csv(spark, str(files), schemas.RAW_COLUMNS)
    rows = raw.orderBy("item_id").collect()
    assert [(r["item_id"], r["url"]) for r in rows] == [(0, "u0"), (1, "u1"), (2, "u2")]
    assert rows[0]["directions"] == 'say "hi"\nthen stir' and rows[0]["calories"] == 1.5 and rows[1]["calories"] is None
    store = tables.Catalogue(str(tmp_path / "store"))
    tables.write_table(raw, store.items_raw)
    again = tables.read_table(spark, store.items_raw, schemas.ITEMS_RAW)
    assert again.exceptAll(raw.select(again.columns)).count() == 0 and again.count() == 3
    tables.write_csv(raw, str(tmp_path / "out"), schemas.TEXT_HEADERS)
    back = tables.read_csv(spark, str(tmp_path / "out"), schemas.TEXT_HEADERS)
    assert {tuple(r)[1:] for r in back.collect()} == {(r["directions"], r["ingr"], r["url"]) for r in rows}


def test_csv_with_a_key(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,URL,Directions,Ingr,more\n7,u,d,i,x\n")
    rows = tables.read_csv(spark, str(tmp_path / "t.csv"), schemas.TEXT_HEADERS, key="id").collect()
    assert [tuple(r) for r in rows] == [(7, "d", "i", "u")]
    with pytest.raises(ValueError, match="columns missing"):
        tables.read_csv(spark, str(tmp_path / "t.csv"), schemas.RAW_COLUMNS)


def test_csv_with_another_header_or_a_bad_key_is_an_error(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    (files / "a.csv").write_text("id,URL,Directions,Ingr\n7,u,d,i\n")
    (files / "b.csv").write_text("id,URL,Ingr,Directions\n8,u,i,d\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(files), schemas.TEXT_HEADERS, key="id").collect()
    (tmp_path / "bad.csv").write_text("id,URL,Directions,Ingr\nseven,u,d,i\n")
    with pytest.raises(Exception, match="no whole number"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), schemas.TEXT_HEADERS, key="id").collect()
    (tmp_path / "nameless.csv").write_text(",URL,Directions,Ingr\n0,u,d,i\n")
    [row] = tables.read_csv(spark, str(tmp_path / "nameless.csv"), schemas.TEXT_HEADERS).collect()
    assert tuple(row) == (0, "d", "i", "u")


def test_encoded_facets_csv(spark, tmp_path):
    head = list(schemas.FACET_HEADERS)
    (tmp_path / "f.csv").write_text(",".join(f'"{h}"' for h in head) + "\n" + ",".join(["1"] * len(head)) + "\n")
    row = tables.read_csv(spark, str(tmp_path / "f.csv"), schemas.FACET_HEADERS, labels_as_codes=True).first()
    assert row["meal"] == 1 and row["time_mins"] == 1 and row["calories"] == 1.0 and row["item_id"] == 0


def test_golden_file(spark, tmp_path):
    golden = {"40": [3, 1], "8": [2**40, 2**40], "7": []}
    (tmp_path / "golden.txt").write_text(json.dumps(golden))
    rows = tables.read_golden(spark, str(tmp_path / "golden.txt")).collect()
    assert sorted(map(tuple, rows)) == [(8, 2**40), (8, 2**40), (40, 1), (40, 3)]


def test_stream_of_queries_and_items(spark, shop, tmp_path):
    _, index, _ = shop
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "query_id long, embedding array<double>")
    asked.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    run = answer_stream(stream, lambda q: index.search(q, 3), str(tmp_path / "out"), str(tmp_path / "cp"))
    query = run.trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).select("query_id", "rank", "item_id")
    assert set(map(tuple, found.collect())) == set(map(tuple, index.search(asked, 3).select("query_id", "rank", "item_id").collect()))

    raw = spark.createDataFrame([(1, "Soup", "1 hr 5 mins")], "item_id long, categories string, total_time string")
    raw.write.parquet(str(tmp_path / "raw"))
    items = label_features(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "raw")))
    sink = items.writeStream.format("memory").queryName("features").trigger(availableNow=True).start()
    sink.awaitTermination()
    assert spark.table("features").select("course", "time_mins").collect() == [("Soup", 65)]


def test_shared_folder_is_the_configured_one(spark):
    from kindred.shared import shared_dir, stored

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = stored(spark.range(3), "three")
    assert kept.count() == 3 and shared_dir(spark) in kept.inputFiles()[0]


def test_scratch_tables_go_with_their_block(spark):
    import os

    from kindred.shared import scratch, stored

    def folder(table):
        return os.path.dirname(table.inputFiles()[0].removeprefix("file://").removeprefix("file:"))

    with scratch(spark) as keep:
        first = folder(stored(spark.range(3), "first"))
        with scratch(spark) as keep_inner:
            second = folder(stored(spark.range(4), "second"))
            lifted = keep_inner(spark.range(5), "lifted")
        assert os.path.exists(first) and not os.path.exists(second) and lifted.count() == 5
        result = keep(lifted, "result")
    assert not os.path.exists(first) and not os.path.exists(folder(lifted)) and result.count() == 5
    with pytest.raises(ValueError), scratch(spark):
        third = folder(stored(spark.range(2), "third"))
        raise ValueError
    assert not os.path.exists(third)
    outside = stored(spark.range(2), "outside")
    assert outside.count() == 2 and spark.sparkContext.applicationId in folder(outside)

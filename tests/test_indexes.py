"""Indexes and joins that read only a part of a table, against versions that compare everything."""

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators import range_grid, scan, topk
from kindred.operators.facets import FacetFilter
from kindred.operators.packed import PackedFacets
from kindred.operators.scorers import DenseScoring
from kindred.plans import clustered_facets, frequent_ngrams, tfidf_search
from kindred.plans.postings_search import PostingsIndex
from kindred.plans.vector_cells import CellIndex

WORDS = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]


def texts(seed, n, common=4):
    """Texts of rare words, and some words that nearly all of them share."""
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randrange(1, 12)) + [w for w in WORDS[:common] if rng.random() < 0.8]) for _ in range(n)]


def plain_overlap(items, queries, k):
    out = []
    for q, *asked in queries:
        scores = []
        for i, *have in items:
            scores.append((-sum(len(set((a or "").split()) & set((b or "").split())) for a, b in zip(asked, have, strict=True)), i))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def overlap(spark, tmp_path_factory):
    items = list(zip(range(300), texts(1, 300), texts(2, 300), strict=True)) + [(300, None, ""), (301, WORDS[5], None)]
    queries = list(zip(range(20), texts(3, 20), texts(4, 20), strict=True)) + [(20, "unknownword", ""), (21, None, None), (22, WORDS[0], WORDS[1])]
    table = spark.createDataFrame(items, "item_id long, directions string, ingr string").repartition(4)
    index = PostingsIndex.fit(table, str(tmp_path_factory.mktemp("index") / "postings"))
    return items, queries, spark.createDataFrame(queries, "query_id long, directions string, ingredients string"), index


@pytest.mark.parametrize("rounds", [(0.02, 0.3, 1.0), (1.0,), (0.0, 0.01, 0.02, 0.05, 1.0)])
def test_postings(overlap, rounds):
    items, queries, asked, index = overlap
    report = []
    assert rows(index.search(asked, 4, rounds=rounds, report=report)) == plain_overlap(items, queries, 4)
    assert sum(done for _, done, _ in report) == len(queries)


def test_postings_stop_early(spark, tmp_path):
    """Queries whose rare words settle the list never read the postings of the common word."""
    items = [(i, f"common {WORDS[i % 50]} {WORDS[i % 50 + 50]}", "") for i in range(500)]
    index = PostingsIndex.fit(spark.createDataFrame(items, "item_id long, directions string, ingr string"), str(tmp_path / "p"))
    queries = [(q, f"common {WORDS[q]} {WORDS[q + 50]}", "") for q in range(5)]
    report = []
    found = index.search(spark.createDataFrame(queries, "query_id long, directions string, ingredients string"), 5, rounds=(0.1, 1.0), report=report)
    assert rows(found) == plain_overlap(items, queries, 5)
    # Ten items of 500 hold a query's two rare words; one round answers every query.
    assert report == [(0.1, 5, 50)]


def test_postings_are_dealt_before_they_meet_queries(spark, overlap, monkeypatch):
    """As many parts as pairs need, so that no task counts the pairs of all items; the lists stay the same."""
    from kindred.plans import postings_search

    parts, stored = [], postings_search.stored
    monkeypatch.setattr(postings_search, "COUNTERS", 200)
    monkeypatch.setattr(postings_search, "stored", lambda df, name: (parts.append((name, df.rdd.getNumPartitions())), stored(df, name))[1])
    test_postings(overlap, (1.0,))
    assert [n for name, n in parts if name == "counted"][0] > 2 * spark.sparkContext.defaultParallelism


def test_postings_of_other_words_are_not_read(spark, overlap):
    *_, index = overlap
    one = spark.createDataFrame([(0, WORDS[7])], "field int, token string")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = index.postings_of(one)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert f"EqualTo(token,{WORDS[7]})" in plan[plan.index("PushedFilters") :]
    assert {r.token for r in index.postings_of(one).select("token").distinct().collect()} == {WORDS[7]}


LIMITS = range_grid.QueryLimits(
    ranges=(("a", "a_min", "a_max"), ("b", None, "b_max"), ("c", "c_min", None)), method=("kind", "kinds"), exclude=(("f", "g"), "without")
)


def limit_tables(spark, n, m, seed=1):
    rng = random.Random(seed)

    def value(low, high):
        return None if rng.random() < 0.1 else float(rng.randrange(low, high))

    items = [(i, value(0, 20), value(0, 5), 7.0 if rng.random() < 0.4 else value(0, 9), rng.choice(["x", "y", None]), rng.choice([0, 1, None]), rng.randrange(2))
             for i in range(n)]
    queries = [(q, value(0, 12), value(5, 20), value(1, 5), value(0, 9), rng.choice([None, [], ["x"], ["Any"], ["y", "x"]]), rng.choice([None, [], ["F"], ["g", "F"]]))
               for q in range(m)]
    return (
        items, queries, spark.createDataFrame(items, "item_id long, a double, b double, c double, kind string, f int, g int"),
        spark.createDataFrame(queries, "query_id long, a_min double, a_max double, b_max double, c_min double, kinds array<string>, without array<string>"),
    )


def plain_candidates(items, queries):
    out = []
    for q, a_min, a_max, b_max, c_min, kinds, without in queries:
        for i, a, b, c, kind, f, g in items:
            inside = all(end is None or (x is not None and sign * x >= sign * end) for x, end, sign in ((a, a_min, 1), (a, a_max, -1), (b, b_max, -1), (c, c_min, 1)))
            method = not kinds or "Any" in kinds or kind in kinds
            flags = not any((f if name.lower() == "f" else g) for name in without or [])
            if inside and method and flags:
                out.append((q, i))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 2, 6])
def test_candidates_per_query(spark, parts):
    items, queries, item_table, query_table = limit_tables(spark, 200, 60)
    grid = range_grid.Grid.over(item_table, LIMITS, parts)
    found = range_grid.candidates_per_query(query_table, item_table, LIMITS, grid)
    assert rows(found) == plain_candidates(items, queries)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_candidates_are_not_broadcast(spark):
    """A query with all its cells is as small as one without for the planner; neither side may go through the driver."""
    items, queries, item_table, query_table = limit_tables(spark, 50, 20)
    found = range_grid.candidates_per_query(query_table, item_table, LIMITS)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == plain_candidates(items, queries)


def test_candidates_of_many_parts_meet_once(spark, monkeypatch):
    """Many parts are split between both sides, so that the rows shuffled grow with their root; every pair is found once."""
    items, queries, item_table, query_table = limit_tables(spark, 200, 60)
    monkeypatch.setattr(range_grid, "PAIRS", 500)
    monkeypatch.setattr(range_grid, "TASKS_OF_PART", 2)
    assert rows(range_grid.candidates_per_query(query_table, item_table, LIMITS)) == plain_candidates(items, queries)
    turns, shares = range_grid.dealt(256, 600_000, 6_000_000)
    assert turns * shares >= 256 and 600_000 * turns + 6_000_000 * shares < 256 * 600_000 / 2
    assert range_grid.dealt(1, 0, 0) == (1, 1) and range_grid.dealt(9, 10, 0) == (1, 9)


def test_limits_on_blocks_of_queries(spark):
    items, queries, item_table, query_table = limit_tables(spark, 90, 40)
    inside = LIMITS.bind(LIMITS.ready(query_table).toArrow())
    found = [np.argwhere(inside(b).T) + [0, 30 * n] for n, b in enumerate(item_table.toArrow().combine_chunks().to_batches(30))]
    assert sorted(map(tuple, np.concatenate(found).tolist())) == plain_candidates(items, queries)


def test_limits_that_cannot_be(spark):
    _, _, items, queries = limit_tables(spark, 20, 5)
    with pytest.raises(Exception, match="unknown ingredient group: plutonium"):
        range_grid.candidates_per_query(queries.withColumn("without", F.array(F.lit("Plutonium"))), items, LIMITS).collect()
    upside_down = queries.withColumn("a_min", F.lit(9.0)).withColumn("a_max", F.lit(3.0))
    assert range_grid.candidates_per_query(upside_down, items, LIMITS).count() == 0
    assert range_grid.candidates_per_query(queries, items.limit(0), LIMITS).count() == 0


def test_merge_cuts_before_it_shuffles(spark):
    partials = spark.range(1000).selectExpr("id % 3 AS query_id", "0 AS kind", "id AS item_id", "cast(id AS double) AS score", "1L AS eligible")
    merged = topk.merge_topk(partials, 2)
    assert [tuple(r) for r in merged.orderBy("query_id", "rank").select("query_id", "item_id").collect()] == [
        (0, 999), (0, 996), (1, 997), (1, 994), (2, 998), (2, 995)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # Printed from the last step to the first: the lowest exchange stands above a limit by rank.
    assert "WindowGroupLimit" in plan[plan.rindex("Exchange hashpartitioning") :]
    assert topk.eligible_items(partials, 0).where("query_id = 0").first()["eligible"] == 334


def test_repeated_ids(spark):
    items = spark.createDataFrame([(1, [1.0]), (1, [2.0]), (2, [1.0])], "item_id long, embedding array<double>")
    asked = spark.createDataFrame([(5, [1.0]), (5, [2.0])], "query_id long, embedding array<double>")
    with pytest.raises(ValueError, match="query_id must stand in its table once"):
        scan.scan_topk(items, asked, DenseScoring(), 2)
    assert rows(scan.repeated_ids(items)) == [(1, 2)]


# ------------------------------------------------------------------ vectors


def clustered_vectors(seed, clusters, members, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim)) * 5
    return [(c[None, :] + rng.normal(size=(members, dim)) * 0.2) for c in centres]


def plain_nearest(items, queries, k, demote=None):
    def cosine(a, b):
        length = math.sqrt(sum(x * x for x in a or [])) * math.sqrt(sum(x * x for x in b or []))
        return sum(x * y for x, y in zip(a, b, strict=True)) / length if length else 0.0

    out = []
    for q, wanted in queries:
        scores = [(cosine(v, wanted), i) for i, v in items]
        scores = [(-1.0 if demote is not None and s > demote else s, i) for s, i in scores]
        out += [(q, rank + 1, i) for rank, (_, i) in enumerate(sorted((-round(s, 9), i) for s, i in scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("k", "demote"), [(3, None), (5, 0.999), (500, None)])
def test_cells(spark, tmp_path, k, demote):
    every = np.concatenate(clustered_vectors(2, 12, 25)).tolist()
    items = list(enumerate(every)) + [(900 + i, every[0]) for i in range(60)] + [(1000, [0.0] * 8), (1001, None)]
    queries = [(q, every[q * 7]) for q in range(20)] + [(50, [0.0] * 8), (51, [-x for x in every[3]]), (52, None)]
    index = CellIndex.fit(spark.createDataFrame(items, "item_id long, embedding array<double>").repartition(3), str(tmp_path / "cells"))
    report = {}
    found = index.search(spark.createDataFrame(queries, "query_id long, embedding array<double>"), k, demote, report)
    assert rows(found.select("query_id", "rank", "item_id")) == plain_nearest(items, queries, k, demote)
    assert index.vectors.count() == len(items)
    if k == 3:
        assert report["visited"] < 0.5 * report["possible"]


@pytest.mark.parametrize("demote", [None, 0.9])
def test_large_blocks_meet_cells_in_single_precision_first(monkeypatch, demote):
    """First cells and later ones, few and most queries asking: the same lists as in double precision."""
    from kindred.operators import scorers
    from kindred.plans import vector_cells

    rng = np.random.default_rng(4)
    def units(n):
        x = rng.normal(size=(n, 4)).round(1)
        x[rng.random(n) < 0.2] = [1.0, 0.0, 0.0, 1.0]
        return x
    pivots = units(6)
    pivots /= np.sqrt((pivots * pivots).sum(axis=1))[:, None]
    x = units(400)
    length = np.sqrt((x * x).sum(axis=1))
    assert (length > 0).all()
    chords = vector_cells._chords(x / length[:, None], pivots)
    cell = chords.argmin(axis=1)
    order = np.lexsort((chords.min(axis=1), cell))
    items = pa.record_batch({"item_id": pa.array(rng.permutation(400)[order], pa.int64()), "embedding": pa.array(x[order].tolist(), pa.list_(pa.float64())),
                             "cell": pa.array(cell[order], pa.int32()), "distance": pa.array(chords.min(axis=1)[order])})
    kinds = np.unique(cell)
    cells = pa.table({"cell": pa.array(kinds, pa.int32()), "n": pa.array([int((cell == c).sum()) for c in kinds], pa.int64()),
                      "least": pa.array([chords.min(axis=1)[cell == c].min() for c in kinds]), "greatest": pa.array([chords.min(axis=1)[cell == c].max() for c in kinds])})
    spec = vector_cells.CellScoring(vector_cells.Layout(pivots, cells, 5), demote)
    asked, near = units(40), 0
    for radius in ([None] * 40, [1.0] * 40, [1.5] * 20 + [0.2] * 20):
        queries = pa.table({"query_id": pa.array(range(40), pa.int64()), "embedding": pa.array(asked.tolist(), pa.list_(pa.float64())), "radius": pa.array(radius, pa.float64())})
        def run():
            found = [r for b in scorers.rank_batches(iter([items]), spec.bind(queries), 5) for r in b.to_pylist()]
            # Beyond the radius nothing counts.
            inside = [r for r in found if radius[0] is None or r["score"] >= 1 - radius[r["query_id"]] ** 2 / 2]
            return sorted((r["query_id"], -round(r["score"], 9), r["item_id"]) for r in inside)
        want = run()
        monkeypatch.setattr(scorers, "_NEAR_QUERIES", 1)
        monkeypatch.setattr(scorers, "_COSINE_CELLS", 40 * 30)
        near += spec.bind(queries).near
        assert run() == want and want
        monkeypatch.undo()
    assert near == 3


def test_cells_store_no_pairs_of_queries_and_cells(spark, tmp_path, monkeypatch):
    """Vectors without clusters rule out nothing; what is stored stays within queries and lists all the same."""
    from kindred.plans import vector_cells

    sizes, stored = [], vector_cells.stored
    monkeypatch.setattr(vector_cells, "stored", lambda df, name: (out := stored(df, name), sizes.append(out.count()))[0])
    every = np.random.default_rng(4).normal(size=(400, 16)).tolist()
    items = list(enumerate(every))
    index = CellIndex.fit(spark.createDataFrame(items, "item_id long, embedding array<double>"), str(tmp_path / "cells"))
    asked = items[:60]
    found = index.search(spark.createDataFrame(asked, "query_id long, embedding array<double>"), 2)
    assert rows(found.select("query_id", "rank", "item_id")) == plain_nearest(items, asked, 2)
    assert max(sizes) <= 60 * 2


def test_cells_with_repeated_rows(spark, tmp_path):
    """A query that stands twice meets each item four times; one without an id has no list."""
    items = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])]
    asked = [(7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [0.0, 1.0]), (None, [1.0, 0.0])]
    index = CellIndex.fit(spark.createDataFrame(items, "item_id long, embedding array<double>"), str(tmp_path / "cells"))
    found = index.search(spark.createDataFrame(asked, "query_id long, embedding array<double>"), 6)
    lists = {q: [r.item_id for r in found.where(F.col("query_id") == q).orderBy("rank").collect()] for q in (7, 8)}
    assert lists == {7: [1, 1, 1, 1, 2, 2], 8: [3, 2, 2, 1]} and found.where("query_id IS NULL").count() == 0


def test_cells_without_vectors(spark, tmp_path):
    none = spark.createDataFrame([(1, None), (2, [])], "item_id long, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 2.0])], "query_id long, embedding array<double>")
    index = CellIndex.fit(none, str(tmp_path / "none"))
    assert rows(index.search(asked, 5)) == [(7, 1, 1, 0.0), (7, 2, 2, 0.0)]
    empty = CellIndex.fit(none.limit(0), str(tmp_path / "empty"))
    assert rows(empty.search(asked, 5)) == []


# ------------------------------------------------------------------ facets


def skipped(path, chosen):
    """Row groups in all, and those whose statistics allow a row inside the ranges."""
    groups = kept = 0
    for file in path.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        places = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(places[c]).statistics for c in chosen}
            groups += 1
            kept += all(stats[c].max >= low and stats[c].min <= high for c, (low, high) in chosen.items())
    return groups, kept


def test_clustered_facets_skip_row_groups(spark, tmp_path):
    names = clustered_facets.CURVE_COLUMNS
    table = spark.range(60_000).select(F.col("id").alias("item_id"), *[(F.rand(i) * 100).alias(c) for i, c in enumerate(names)])
    clustered_facets.write_clustered(table, str(tmp_path / "curve"), row_group_bytes=32 * 1024)
    table.sortWithinPartitions("calories").write.option("parquet.block.size", 32 * 1024).option("parquet.page.size.row.check.max", 100).parquet(
        str(tmp_path / "sorted"))
    chosen = {"protein": (0.0, 20.0), "carbs": (70.0, 100.0)}  # nothing about the first column
    groups, kept = skipped(tmp_path / "curve", chosen)
    _, of_sorted = skipped(tmp_path / "sorted", chosen)
    # Some 90 groups are six to seven bits, one or two for each column: half or a quarter of either range.
    assert groups > 50 and kept < groups / 3 and kept < of_sorted / 2
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert back.agg(F.bit_xor(F.xxhash64(*table.columns))).first() == table.agg(F.bit_xor(F.xxhash64(*table.columns))).first()


def test_clustered_facets_of_a_large_table_have_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clustered_facets, "ROWS_OF_A_TASK", 10)
    table = spark.range(200).selectExpr("id AS item_id", "double(id % 13) AS a", "double(id % 7) AS b")
    clustered_facets.write_clustered(table, str(tmp_path / "many"), ["a", "b"])
    assert len(list((tmp_path / "many").glob("*.parquet"))) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(rows(spark.read.parquet(str(tmp_path / "many")))) == sorted(rows(table))


def test_clustered_facets_with_missing_and_equal_values(spark, tmp_path):
    table = spark.range(100).select(
        F.col("id").alias("item_id"), F.lit(5.0).alias("calories"), F.lit(None).cast("double").alias("protein"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("fat"), F.lit(1.0).alias("carbs"), F.col("id").alias("time_mins"))
    clustered_facets.write_clustered(table, str(tmp_path / "odd"))
    assert rows(spark.read.parquet(str(tmp_path / "odd")).na.fill(-1)) == rows(table.na.fill(-1))
    clustered_facets.write_clustered(table.limit(0), str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).count() == 0


def test_packed_facets(spark):
    labels = {"kind": [f"k{i}" for i in range(90)], "size": [1, 2, 3]}
    table = spark.createDataFrame(
        [(1, 1, 0, "k0", 1), (2, 0, 0, "k70", 2), (3, None, 1, "k89", 9), (4, 0, 0, None, None), (5, 0, 1, "other", 3)],
        "item_id long, nuts int, meat int, kind string, size int")
    layout = PackedFacets.of(["nuts", "meat"], labels)
    assert len(layout.names()) == 2  # 95 bits
    bits = layout.pack(table, "item_id")
    assert [r[0] for r in bits.where(layout.none_of(["nuts", "meat"])).orderBy("item_id").collect()] == [2, 4]
    assert [r[0] for r in bits.where(layout.one_of("kind", ["k0", "k89", "other"])).orderBy("item_id").collect()] == [1, 3]
    matches = bits.select("item_id", layout.matches({"kind": "k70", "size": 2}).alias("n"))
    assert rows(matches) == [(1, 0), (2, 2), (3, 0), (4, 0), (5, 0)]
    assert bits.where(layout.none_of([])).count() == 5
    with pytest.raises(ValueError, match="colour has no bits"):
        layout.matches({"colour": "red"})


# ------------------------------------------------------------------ frequent n-grams


def test_frequent_ngrams_are_exact(spark):
    docs = spark.createDataFrame(list(enumerate(texts(9, 120) + ["", None, "zzzz"])), "item_id long, text string").repartition(3)
    counted = tfidf_search.frequencies(docs, word_sizes=None)
    wanted = rows(tfidf_search.char_vocabulary(counted, 123, most=40))
    for size in (10, 41, 5000):  # the smaller ones run over and are doubled
        report = []
        assert rows(frequent_ngrams.char_vocabulary(docs, 123, most=40, size=size, report=report)) == wanted
        assert report[0] == size and (size == 5000) == (len(report) == 1)


def test_summary_is_never_too_high_and_says_how_short_it_is():
    rng = np.random.default_rng(4)
    stream = [f"t{x}" for x in rng.zipf(1.3, 20_000) % 3000]
    summary = frequent_ngrams.Summary(100)
    for at in range(0, len(stream), 500):
        terms, counts = np.unique(stream[at : at + 500], return_counts=True)
        summary.add(terms.tolist(), counts.tolist())
    summary.lower()
    true = dict(zip(*np.unique(stream, return_counts=True), strict=True))
    assert len(summary.counts) <= 100 and summary.short > 0
    for term, n in true.items():
        assert 0 <= n - summary.counts.get(term, 0) <= summary.short


def test_filter_of_clustered_table(spark, tmp_path):
    """A filter record works on the clustered table as on any other."""
    flags = {c: 0 for c in K.FLAG_COLUMNS}
    table = spark.createDataFrame(
        [(i, float(i), 1.0, 1.0, 1.0, "Baking", i, *flags.values()) for i in range(50)],
        "item_id long, calories double, protein double, fat double, carbs double, cooking_methods string, time_mins int, "
        + ", ".join(f"{c} int" for c in flags))
    clustered_facets.write_clustered(table, str(tmp_path / "t"))
    found = FacetFilter(calories=(10, 20), max_minutes=15).candidates(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r[0] for r in found.collect()) == list(range(10, 16))

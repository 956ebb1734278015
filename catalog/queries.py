"""One registered query per operator, over whole driver tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import standins as S
from kindred import constants as K
from kindred.functions import models, scalars, tokens, vectors
from kindred.operators import dictionary, facets, flags, packed, range_grid, topk
from kindred.plans import (
    clustered_facets,
    evaluation,
    feature_build,
    filtered_search,
    frequent_ngrams,
    label_store,
    postings_search,
    text_search,
    tfidf_search,
    vector_cells,
    vector_search,
    vocabulary_join,
)
from kindred.shared import shared_dir, ship_package, stored
from kindred.sources import positions, schemas, tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL side.
FILTER = facets.FacetFilter(
    methods=["1-URGENT", "3-MEDIUM"], exclude=["Seafood", "Nuts"],
    calories=(1000, 300000), protein=(0, 40), fat=(0, 50), carbs=(0, 100), max_minutes=300,
)
OPEN_FILTER = facets.FacetFilter(calories=(1000, 400000), protein=None, fat=None, carbs=None)
COLOURS = ["red", "blue", "hot", "cold", "old"]
WORD_VOCABULARY = ["gear", "old rod", "Brand", "ring"]
CLEAN_VOCABULARY = ["red", "gear", "Brand"]
BAND = (0.2, 0.45)
BLEND_FACETS = ["label", "first_sign", "second_sign"]
MATCH_VALUES = {"label": 3, "first_sign": 1, "second_sign": "up"}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ------------------------------------------------------------------ facets


def facet_filter(spark, sf):
    return FILTER.candidates(S.facets(spark, sf))


def facet_filter_clustered(spark, sf):
    """The same filter over facets written along a curve, so that it skips row groups."""
    path = _folder(spark, "curve")
    rows = S.facets(spark, sf)
    clustered_facets.write_clustered(rows, path, row_group_bytes=64 * 1024)
    return FILTER.candidates(spark.read.schema(rows.schema).parquet(path))


def facet_filter_packed(spark, sf):
    """The same filter with methods and exclusions as masks of bits."""
    rows = S.facets(spark, sf)
    methods = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    layout = packed.PackedFacets.of(K.FLAG_COLUMNS, {"cooking_methods": methods})
    ranges = dataclasses.replace(FILTER, methods=(), exclude=())
    bits = layout.pack(rows, "item_id", *K.NUTRIENT_COLUMNS, "time_mins").where(ranges.predicate())
    excluded = layout.none_of([g.lower() for g in FILTER.exclude])
    return bits.where(layout.one_of("cooking_methods", FILTER.methods) & excluded).select("item_id")


def facet_match_packed(spark, sf):
    layout = packed.PackedFacets.of(labels={"label": range(10), "first_sign": [0, 1], "second_sign": ["up", "down"]})
    bits = layout.pack(S.vectors(spark, sf), "item_id")
    return bits.select("item_id", layout.matches(MATCH_VALUES).alias("matches"))


def request_guards(spark, sf):
    """Orders as search requests: the customer number as k, the status as the wanted facet."""
    features = F.nullif(F.col("o_orderstatus"), F.lit("P")).isNotNull()
    status = facets.request_status(F.col("o_custkey") % 60, K.USER_K_MAX, features)
    return S.table(spark, sf, "orders").select("o_orderkey", status.alias("status"))


def facet_gate(spark, sf):
    return facets.gate_by_group(S.facets(spark, sf), "meal", FILTER.predicate())


def multi_hot(spark, sf):
    lines = S.table(spark, sf, "lineitem")
    return flags.flags_of_rows(lines, "l_orderkey", "l_returnflag", ["A", "N", "R", "X"], ["a", "n", "r", "x"])


def multi_hot_array(spark, sf):
    words = F.split(F.col("p_name"), " ", -1)
    return S.table(spark, sf, "part").select(
        "p_partkey", *[c.alias(n) for n, c in flags.flags_of_array(words, COLOURS, COLOURS).items()]
    )


def label_encode(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return dictionary.encode_labels(orders, ["o_orderpriority", "o_orderstatus"], "o_orderkey")[0]


def label_dictionary(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return dictionary.label_dictionary(orders, ["o_orderpriority", "o_orderstatus"])


def facet_match(spark, sf):
    return S.vectors(spark, sf).select("item_id", facets.facet_matches(MATCH_VALUES).alias("matches"))


def max_minutes(spark, sf):
    return S.table(spark, sf, "part").select(
        "p_partkey", scalars.max_minutes(F.floor(F.col("p_size") / 10), F.col("p_size")).alias("minutes")
    )


# ------------------------------------------------------------------ scalars


def first_category(spark, sf):
    return S.table(spark, sf, "part").select(
        "p_partkey", scalars.first_category(F.col("p_name"), COLOURS).alias("category")
    )


def contains_flag(spark, sf):
    return S.text_table(spark, sf, "documents", "doc_id").select(
        "doc_id", scalars.contains_flag(F.col("text"), "the").alias("flag")
    )


def normalize_categories(spark, sf):
    names = scalars.normalize_categories(S.part_categories())
    return S.text_table(spark, sf, "part", "p_partkey").select("p_partkey", scalars.set_to_text(names).alias("categories"))


def drop_combined(spark, sf):
    words = F.split(F.col("p_name"), " ", -1)
    names = F.array_distinct(F.concat(words, F.array("p_name", F.lower("p_type"), F.concat_ws(" ", "p_name", F.lower("p_type")))))
    kept = scalars.drop_combined(names)
    return S.text_table(spark, sf, "part", "p_partkey").select("p_partkey", scalars.set_to_text(kept).alias("kept"))


def vocab_split(spark, sf):
    names = F.array(S.part_categories(), F.col("p_name"))
    return S.text_table(spark, sf, "part", "p_partkey").select(
        "p_partkey", scalars.split_by_vocabulary(names, WORD_VOCABULARY).alias("parts")
    )


def _part_vocabulary(spark, sf):
    """Brands, names and words of names, in an order of their own."""
    words = F.concat(F.array("p_brand", "p_name"), F.split("p_name", " ", -1))
    names = S.table(spark, sf, "part").select(F.explode(words).alias("name")).distinct()
    return names.withColumn("pos", F.conv(F.substring(F.md5("name"), 1, 15), 16, 10).cast("bigint"))


def first_category_table(spark, sf):
    return vocabulary_join.first_category(S.table(spark, sf, "part"), "p_partkey", "p_name", _part_vocabulary(spark, sf))


def vocab_split_table(spark, sf):
    rows = S.table(spark, sf, "part").select("p_partkey", F.array(S.part_categories(), F.col("p_name")).alias("names"))
    return vocabulary_join.split_by_vocabulary(rows, "p_partkey", "names", _part_vocabulary(spark, sf))


def clean_categories(spark, sf):
    return S.text_table(spark, sf, "part", "p_partkey").select(
        "p_partkey", scalars.clean_categories(S.part_categories(), CLEAN_VOCABULARY).alias("categories")
    )


def time_to_minutes(spark, sf):
    return S.table(spark, sf, "part").select(
        "p_partkey", S.size_as_time().alias("total_time"), scalars.time_to_minutes(S.size_as_time()).alias("minutes")
    )


def unreadable_times(spark, sf):
    """Durations that give no minutes, counted per brand."""
    bad = scalars.unreadable_time(S.size_as_time()).cast("long")
    return S.table(spark, sf, "part").groupBy("p_brand").agg(F.sum(bad).alias("unreadable"), F.count("*").alias("n"))


def line_split(spark, sf):
    listed = F.replace(F.col("text"), F.lit(". "), F.lit(",  "))
    return S.text_table(spark, sf, "documents", "doc_id").select(
        "doc_id", F.posexplode(scalars.split_lines(listed)).alias("pos", "line")
    )


def _word_sets(spark, sf):
    docs = S.text_table(spark, sf, "documents", "doc_id")
    return docs.select("doc_id", tokens.unique_words(F.col("text")).alias("words"))


def unique_words(spark, sf):
    return _word_sets(spark, sf).select(
        "doc_id", F.size("words").alias("n"), F.array_join("words", ",").alias("words")
    )


def word_overlap(spark, sf):
    pair = [tokens.unique_words(F.col("p_name")), tokens.unique_words(F.concat_ws(" ", "p_type", F.lit("red old rods")))]
    return S.text_table(spark, sf, "part", "p_partkey").select(
        "p_partkey", tokens.word_overlap(pair[:1], pair[1:]).alias("shared")
    )


def array_roundtrip(spark, sf):
    texts = _word_sets(spark, sf).withColumn("text", scalars.set_to_text(F.col("words")))
    back = texts.withColumn("back", scalars.text_to_set(F.col("text")))
    return back.select(
        "doc_id", F.size("back").alias("n"), (F.col("back") == F.col("words")).cast("int").alias("same")
    )


def golden_file(spark, sf):
    """The same pairs written as golden files, a hundred conversations to a file, and read back."""
    path = _folder(spark, "golden")
    pairs = S.replies(spark, sf).withColumn("part", F.expr("query_id DIV 100000"))
    entry = F.struct(F.col("query_id").cast("string").alias("key"), F.array("relevant_id", "query_id").alias("value"))
    objects = pairs.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    objects.write.partitionBy("part").text(path)
    return tables.read_golden(spark, path)


def golden_explode(spark, sf):
    """Golden JSON written from the replies, then read with the golden parser."""
    pairs = S.replies(spark, sf)
    ids = F.array("relevant_id", "query_id")
    text = F.to_json(F.create_map(F.col("query_id").cast("string"), ids))
    return tables.golden_rows(pairs.select(text.alias("value")))


# ------------------------------------------------------------------ text search


def word_overlap_topk(spark, sf):
    index = text_search.WordOverlapIndex.fit(S.documents(spark, sf))
    return index.search(S.benchmark_queries(spark, sf), 10)


def word_overlap_postings(spark, sf):
    """The same lists from an inverted index, rare words first."""
    index = postings_search.PostingsIndex.fit(S.documents(spark, sf), _folder(spark, "postings"))
    return index.search(S.benchmark_queries(spark, sf), 10)


def _blocks(asked):
    """Half the queries to a broadcast: the way of a query table too large for one, at every scale."""
    return {"max_rows": max(1, asked.count() // 2)}


def word_overlap_blocks(spark, sf):
    asked = S.benchmark_queries(spark, sf)
    return text_search.WordOverlapIndex.fit(S.documents(spark, sf)).search(asked, 10, scan=_blocks(asked))


def _docs(spark, sf):
    return S.documents(spark, sf).select("item_id", F.col("directions").alias("text"))


def word_ngrams(spark, sf):
    return tfidf_search.frequencies(_docs(spark, sf), char_sizes=None).drop("kind")


def char_ngrams(spark, sf):
    return tfidf_search.frequencies(_docs(spark, sf), word_sizes=None).drop("kind")


def term_frequency(spark, sf):
    return tfidf_search.word_counts(_docs(spark, sf))


def tfidf_vocab(spark, sf):
    docs = _docs(spark, sf)
    counted = tfidf_search.frequencies(docs, word_sizes=None)
    return rounded(tfidf_search.char_vocabulary(counted, docs.count()), "idf")


def tfidf_vocab_two_pass(spark, sf):
    """The same vocabulary from bounded summaries and exact counts of their survivors."""
    docs = _docs(spark, sf)
    return rounded(frequent_ngrams.char_vocabulary(docs, docs.count()), "idf")


def tfidf_idf(spark, sf):
    docs = _docs(spark, sf)
    known = tfidf_search.word_vocabulary(tfidf_search.frequencies(docs, char_sizes=None), docs.count())
    return rounded(known.where(F.col("idf").isNotNull()), "idf")


def tfidf_norms(spark, sf):
    docs = _docs(spark, sf)
    n = docs.count()
    counted = stored(tfidf_search.frequencies(docs), "tfidf-frequencies")
    index = tfidf_search.TfidfIndex(
        tfidf_search.word_vocabulary(counted, n), tfidf_search.char_vocabulary(counted, n)
    )
    return rounded(index.lengths(docs).drop("text"), "word", "char")


def tfidf_topk(spark, sf):
    index = tfidf_search.TfidfIndex.fit(S.documents(spark, sf))
    return rounded(index.search(S.benchmark_queries(spark, sf), 10), "score")


def tfidf_blocks(spark, sf):
    asked = S.benchmark_queries(spark, sf)
    index = tfidf_search.TfidfIndex.fit(S.documents(spark, sf))
    return rounded(index.search(asked, 10, scan=_blocks(asked)), "score")


# ------------------------------------------------------------------ vector search


def _index(spark, sf):
    return vector_search.EmbeddingIndex(S.vectors(spark, sf))


def vector_topk(spark, sf):
    return rounded(_index(spark, sf).search(S.vector_queries(spark, sf), 10, demote=None), "score")


def vector_topk_blocks(spark, sf):
    asked = S.vector_queries(spark, sf)
    return rounded(_index(spark, sf).search(asked, 10, demote=None, scan=_blocks(asked)), "score")


def vector_topk_cells(spark, sf):
    """The same lists from cells that the triangle inequality can rule out."""
    index = vector_cells.CellIndex.fit(S.vectors(spark, sf), _folder(spark, "cells"))
    return rounded(index.search(S.vector_queries(spark, sf), 10), "score")


def vector_topk_some_facets(spark, sf):
    """Most items have no facets; a search without limits finds them all the same."""
    some = FILTER.candidates(S.facets(spark, sf))
    index = vector_search.EmbeddingIndex.fit(S.vectors(spark, sf), facets=some)
    return rounded(index.search(S.vector_queries(spark, sf), 10, demote=None), "score")


def vector_topk_filtered(spark, sf):
    kept = OPEN_FILTER.candidates(S.facets(spark, sf))
    found = _index(spark, sf).search(S.vector_queries(spark, sf), 10, candidates=kept)
    return rounded(found, "score")


def cosine_pairs(spark, sf):
    """Single-pair expressions: each vector against its own first half doubled up."""
    half = F.concat(F.slice("embedding", 1, 32), F.slice("embedding", 1, 32))
    similarity = vectors.cosine(F.col("embedding"), half)
    return rounded(
        S.vectors(spark, sf).select(
            "item_id",
            similarity.alias("similarity"),
            vectors.demote_duplicates(similarity, 0.7).alias("demoted"),
            vectors.blend(similarity, facets.facet_matches(MATCH_VALUES), 3, 0.6).alias("blended"),
        ),
        "similarity", "demoted", "blended",
    )


def blend_topk(spark, sf):
    found = _index(spark, sf).search_blended(S.vector_queries(spark, sf), BLEND_FACETS, 10, BAND)
    return rounded(found, "score")


def blend_fallback(spark, sf):
    return rounded(_index(spark, sf).search_blended(S.vector_queries(spark, sf), BLEND_FACETS, 10), "score")


def result_lookup(spark, sf):
    pages = S.text_table(spark, sf, "pages", "page_id")
    items = pages.select(F.col("page_id").alias("item_id"), F.col("html").alias("directions"))
    asked = S.benchmark_queries(spark, sf)
    found = text_search.WordOverlapIndex.fit(items, ["directions"]).search(asked, 5, ["directions"])
    return topk.lookup(found, pages.select(F.col("page_id").alias("item_id"), "url"))


def encode_concat(spark, sf):
    both = models.encode_fields([F.col("text"), F.concat_ws(" ", "lang", "source")])
    return rounded(
        S.text_table(spark, sf, "documents", "doc_id")
        .select("doc_id", F.posexplode(both).alias("slot", "value"))
        .withColumn("value", F.col("value").cast("double")),
        "value",
    )


def zero_shot(spark, sf):
    best = models.classify(F.col("text"), ["Pronoun", "Article", "French"], LANGUAGE_CLASSIFIER)
    rows = S.text_table(spark, sf, "documents", "doc_id").select("doc_id", best.alias("best"))
    return rounded(rows.select("doc_id", "best.label", "best.score"), "score")


def zero_shot_columns(spark, sf):
    best = models.lexicon_label(F.col("text"), LANGUAGE_LEXICON, ["Pronoun", "Article", "French"])
    rows = S.text_table(spark, sf, "documents", "doc_id").select("doc_id", best.alias("best"))
    return rounded(rows.select("doc_id", "best.label", "best.score"), "score")


LANGUAGE_LEXICON = {"Pronoun": ["it", "that", "they"], "Article": ["the", "an", "la"], "French": ["le", "la", "des"]}
LANGUAGE_CLASSIFIER = models.partial(models.lexicon_classifier, LANGUAGE_LEXICON)


# ------------------------------------------------------------------ stores


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark, sf):
    """Documents written as CSV, their multi-line texts read back by declared columns."""
    path = _folder(spark, "csv")
    headers = {"id": "item_id", "Directions": "directions", "Ingr": "ingr", "URL": "url"}
    docs = S.table(spark, sf, "documents").select(
        F.col("doc_id").alias("item_id"), F.col("text").alias("directions"), F.col("lang").alias("ingr"),
        F.concat_ws("/", "lang", "source").alias("url"),
    )
    tables.write_csv(docs, path, headers)
    return tables.read_csv(spark, path, schemas.TEXT_HEADERS, key="id")


def csv_line_ids(spark, sf):
    """The same without an id column: ids number the lines, in the order of one sorted file."""
    path = _folder(spark, "csv")
    docs = S.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("directions"), F.col("lang").alias("ingr"), F.col("source").alias("url")
    )
    tables.write_csv(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), path, schemas.TEXT_HEADERS)
    return tables.read_csv(spark, path, schemas.TEXT_HEADERS)


def facets_csv_roundtrip(spark, sf):
    """Facets written as CSV and read back by their declared columns."""
    path = _folder(spark, "facets")
    rows = S.facets(spark, sf)
    headers = {h: c for h, c in schemas.FACET_HEADERS.items() if c in rows.columns}
    tables.write_csv(rows, path, {"id": "item_id", **headers})
    return tables.read_csv(spark, path, headers, key="id")


def encoded_csv_roundtrip(spark, sf):
    """Facets with labels as codes written as CSV and read back."""
    path = _folder(spark, "encoded")
    rows = feature_build.build_features(S.raw_items(spark, sf)).facets_encoded
    tables.write_csv(rows, path, {"id": "item_id", **schemas.FACET_HEADERS})
    return tables.read_csv(spark, path, schemas.FACET_HEADERS, key="id", labels_as_codes=True)


def csv_bad_cells(spark, sf):
    """Orders as facets in which some prices and days are words."""
    path = _folder(spark, "bad")
    price = F.when(F.col("o_orderstatus") == "F", F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.dayofyear("o_orderdate").cast("string"))
    header_of = {c: h for h, c in schemas.FACET_HEADERS.items()}
    orders = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), price.alias("calories"), F.concat(day, F.lit("d")).alias("time_mins"), F.lit(None).cast("string").alias("fat")
    )
    headers = {header_of[c]: c for c in ("calories", "time_mins", "fat")}
    tables.write_csv(orders, path, headers)
    return tables.unreadable_cells(spark, path, headers)


def positional_align(spark, sf):
    """Two tables in the order of their rows, without a key in the second, laid side by side."""
    docs = S.table(spark, sf, "documents").repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id")
    left = stored(docs.select("doc_id", F.length("text").alias("n")), "left")
    right = stored(docs.select("lang", F.sha2("text", 256).alias("digest")), "right")
    return positions.align(left, right)


def token_sets_parquet(spark, sf):
    """Token sets stored as a table, read back and searched."""
    path = _folder(spark, "sets")
    text_search.WordOverlapIndex.fit(S.turns(spark, sf)).write(path)
    return text_search.WordOverlapIndex.read(spark, path).search(_turn_queries(spark, sf), 5)


def token_store(spark, sf):
    """Token sets written in their text form and read back, then searched."""
    path = _folder(spark, "tokens")
    text_search.WordOverlapIndex.fit(S.turns(spark, sf)).write_csv(path)
    index = text_search.WordOverlapIndex.read_csv(spark, path)
    return index.search(_turn_queries(spark, sf), 5)


def vector_store(spark, sf):
    path = _folder(spark, "vectors")
    _index(spark, sf).write(path)
    index = vector_search.EmbeddingIndex.read(spark, path)
    return rounded(index.search(S.vector_queries(spark, sf), 3), "score")


def tfidf_store(spark, sf):
    path = _folder(spark, "tfidf")
    tfidf_search.TfidfIndex.fit(S.turns(spark, sf)).write(path)
    index = tfidf_search.TfidfIndex.read(spark, path)
    return rounded(index.search(_turn_queries(spark, sf), 5), "score")


def _turn_queries(spark, sf):
    return evaluation.queries_from_items(S.turns(spark, sf), S.replies(spark, sf))


def lemma_table(spark, sf):
    """Token sets with a table of lemmas: every word of a part name without its ending."""
    parts = S.table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("words")
    )
    surface = F.explode(F.split("p_name", " ", -1))
    lemmas = S.table(spark, sf, "part").select(surface.alias("surface")).distinct()
    lemmas = lemmas.withColumn("lemma", F.regexp_replace("surface", "(ing|ed|er|s)$", ""))
    sets = text_search.token_sets(parts, "item_id", ["words"], lemmas=lemmas)
    return sets.select("item_id", scalars.set_to_text(F.col("words")).alias("words"))


# ------------------------------------------------------------------ jobs


def ingredient_flags(spark, sf):
    return feature_build.ingredient_flags(S.raw_items(spark, sf))


def ingredient_labels(spark, sf):
    lines = S.raw_items(spark, sf).select(F.explode(scalars.split_lines(F.col("ingr"))).alias("line"))
    return feature_build.ingredient_labels(lines)


def label_batches(spark, sf):
    """Lines labelled in two runs: the second sends only what the first has not seen."""
    store = label_store.LabelStore(spark, _folder(spark, "labels"))
    raw = S.raw_items(spark, sf)
    lines = raw.select("item_id", "fat", F.explode(scalars.split_lines(F.col("ingr"))).alias("line"))
    store.add(lines.where("fat <= 10").select("line"), batch="first")
    store.add(lines.select("line"), batch="second")
    return store.labelled(lines.select("item_id", "line"), "item_id")


def evaluation_facets(spark, sf):
    """The facets the blended search compares, without missing values."""
    facet_rows = S.facets(spark, sf).withColumn("course", F.nullif(F.col("course"), F.lit("F")))
    kept = facet_rows.select("item_id", *K.EVALUATION_FACETS)
    return kept.na.fill(0, K.FLAG_COLUMNS).na.fill("0", ["meal", "course", "cooking_methods"])


def query_guard(spark, sf):
    """Orders as queries whose second field is empty for some."""
    asked = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("query_id"),
        F.col("o_orderpriority").alias("directions"),
        F.when(F.col("o_orderstatus") == "F", "").when(F.col("o_orderstatus") == "O", "x").alias("ingredients"),
    )
    return asked.where(facets.complete_query("directions", "ingredients")).select("query_id")


def feature_build_query(spark, sf):
    return feature_build.build_facets(S.raw_items(spark, sf))


def feature_build_encoded(spark, sf):
    return feature_build.build_features(S.raw_items(spark, sf)).facets_encoded


def _searchable(spark, sf):
    """Embeddings with their facets in one table, stored as an index is: a search reads it several times."""
    rows = S.vectors(spark, sf).select("item_id", "embedding").join(S.facets(spark, sf), "item_id")
    return vector_search.EmbeddingIndex(stored(rows, "index"))


def _order_pages(spark, sf):
    return S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("url")
    )


def _filtered_queries(spark, sf):
    """Every vector asks with limits of its own, taken from its label."""
    asked = S.vector_queries(spark, sf)
    label = F.col("label")
    return asked.select(
        "query_id",
        "embedding",
        F.when(label == 0, "").otherwise("mix and bake").alias("directions"),
        F.lit("flour").alias("ingredients"),
        F.when(label < 3, F.array(F.lit("Any"))).when(label < 6, F.array(F.lit("1-URGENT"), F.lit("5-LOW")))
        .otherwise(F.array().cast("array<string>")).alias("methods"),
        F.when(label > 7, F.array(F.lit("Nuts"))).otherwise(F.array().cast("array<string>")).alias("exclude"),
        F.lit(1000.0).alias("calories_min"),
        (100000.0 + label * 50000).alias("calories_max"),
        F.when(label == 4, F.lit(150.0)).alias("max_minutes"),
    )


def candidates_per_query(spark, sf):
    """Every pair of a query and an item inside its limits."""
    asked = facets.with_limits(_filtered_queries(spark, sf))
    return range_grid.candidates_per_query(asked, _searchable(spark, sf).vectors, facets.QUERY_LIMITS)


def search_e2e(spark, sf):
    found = filtered_search.filtered_search(
        _filtered_queries(spark, sf), _searchable(spark, sf), _order_pages(spark, sf), 5, 40
    )
    return rounded(found, "score")


def search_unlinked(spark, sf):
    """The same where only some items have a link: no rank and no query is lost."""
    linked = S.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("item_id"))
    pages = _order_pages(spark, sf).join(linked, "item_id", "left_semi")
    found = filtered_search.filtered_search(_filtered_queries(spark, sf), _searchable(spark, sf), pages, 5, 40)
    return rounded(found, "score")


def search_shared_filter(spark, sf):
    found = filtered_search.search_with_filter(
        S.vector_queries(spark, sf), _searchable(spark, sf), OPEN_FILTER, _order_pages(spark, sf), 5
    )
    return rounded(found, "score")


def _vector_golden(spark, sf):
    """For each vector the two that follow it."""
    return S.vectors(spark, sf).select(
        F.col("item_id").alias("query_id"), F.explode(F.array(F.col("item_id") + 1, F.col("item_id") + 2)).alias("relevant_id")
    )


def _vector_predictions(spark, sf):
    index, asked = _index(spark, sf), S.vector_queries(spark, sf)
    return {
        "restricted": index.search(asked, 10),
        "blended": index.search_blended(asked, BLEND_FACETS, 10, BAND),
    }


def hit_report(spark, sf):
    return rounded(evaluation.hit_report(_vector_predictions(spark, sf), _vector_golden(spark, sf)), "hit_pct")


def eval_listing(spark, sf):
    return evaluation.evaluation_listing(
        _vector_predictions(spark, sf), _vector_golden(spark, sf), _order_pages(spark, sf)
    )


def method_report(spark, sf):
    """All four methods on conversation turns: is the reply among the turns found?"""
    items = S.turns(spark, sf)
    golden = S.replies(spark, sf)
    asked = evaluation.queries_from_items(items, golden)
    by_role = vector_search.EmbeddingIndex.fit(items, facets=items.select("item_id", F.col("ingr").alias("role")))
    predictions = {
        "words": text_search.WordOverlapIndex.fit(items).search(asked, 10),
        "tfidf": tfidf_search.TfidfIndex.fit(items).search(asked, 10),
        "embedding": by_role.search(asked, 10),
        "blended": by_role.search_blended(
            asked.withColumn("role", F.lit("assistant")), ["role"], 10, band=(0.3, K.BLEND_DUPLICATE)
        ),
    }
    return rounded(evaluation.hit_report(predictions, golden), "hit_pct")


_ALL: dict[str, Query] = {
    "facet_filter": facet_filter,
    "facet_gate": facet_gate,
    "facet_match": facet_match,
    "multi_hot": multi_hot,
    "multi_hot_array": multi_hot_array,
    "label_encode": label_encode,
    "label_dictionary": label_dictionary,
    "max_minutes": max_minutes,
    "first_category": first_category,
    "contains_flag": contains_flag,
    "normalize_categories": normalize_categories,
    "drop_combined": drop_combined,
    "vocab_split": vocab_split,
    "clean_categories": clean_categories,
    "time_to_minutes": time_to_minutes,
    "unreadable_times": unreadable_times,
    "line_split": line_split,
    "unique_words": unique_words,
    "word_overlap": word_overlap,
    "array_roundtrip": array_roundtrip,
    "golden_explode": golden_explode,
    "word_overlap_topk": word_overlap_topk,
    "word_overlap_blocks": word_overlap_blocks,
    "word_ngrams": word_ngrams,
    "char_ngrams": char_ngrams,
    "term_frequency": term_frequency,
    "tfidf_vocab": tfidf_vocab,
    "tfidf_idf": tfidf_idf,
    "tfidf_norms": tfidf_norms,
    "tfidf_topk": tfidf_topk,
    "tfidf_blocks": tfidf_blocks,
    "cosine_pairs": cosine_pairs,
    "vector_topk": vector_topk,
    "vector_topk_blocks": vector_topk_blocks,
    "vector_topk_some_facets": vector_topk_some_facets,
    "vector_topk_filtered": vector_topk_filtered,
    "blend_topk": blend_topk,
    "blend_fallback": blend_fallback,
    "result_lookup": result_lookup,
    "csv_roundtrip": csv_roundtrip,
    "csv_line_ids": csv_line_ids,
    "facets_csv_roundtrip": facets_csv_roundtrip,
    "token_sets_parquet": token_sets_parquet,
    "token_store": token_store,
    "vector_store": vector_store,
    "tfidf_store": tfidf_store,
    "lemma_table": lemma_table,
    "ingredient_labels": ingredient_labels,
    "evaluation_facets": evaluation_facets,
    "query_guard": query_guard,
    "encode_concat": encode_concat,
    "zero_shot": zero_shot,
    "ingredient_flags": ingredient_flags,
    "feature_build": feature_build_query,
    "feature_build_encoded": feature_build_encoded,
    "search_e2e": search_e2e,
    "search_unlinked": search_unlinked,
    "search_shared_filter": search_shared_filter,
    "hit_report": hit_report,
    "eval_listing": eval_listing,
    "method_report": method_report,
    "facet_filter_clustered": facet_filter_clustered,
    "facet_filter_packed": facet_filter_packed,
    "facet_match_packed": facet_match_packed,
    "request_guards": request_guards,
    "first_category_table": first_category_table,
    "vocab_split_table": vocab_split_table,
    "golden_file": golden_file,
    "word_overlap_postings": word_overlap_postings,
    "tfidf_vocab_two_pass": tfidf_vocab_two_pass,
    "vector_topk_cells": vector_topk_cells,
    "zero_shot_columns": zero_shot_columns,
    "encoded_csv_roundtrip": encoded_csv_roundtrip,
    "csv_bad_cells": csv_bad_cells,
    "positional_align": positional_align,
    "label_batches": label_batches,
    "candidates_per_query": candidates_per_query,
}


def _with_package(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {name: _with_package(query) for name, query in _ALL.items()}

"""Each search against a plain Python model on small fixtures, with one query block and with several."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators.scorers import DenseScoring, RunningTopK, SparseScoring, rank_batches
from kindred.operators.scan import scan_topk, table_size
from kindred.operators.topk import check_k, lookup, merge_topk, ranked, topk_per_query
from kindred.plans.text_search import WordOverlapIndex, token_sets
from kindred.plans.tfidf_search import TfidfIndex
from kindred.plans.vector_search import EmbeddingIndex, embed

BLOCKS = {"max_rows": 3}


def lists(result, *extra):
    out = {}
    for r in result.orderBy("query_id", "rank").collect():
        entry = (r["item_id"], *[r[c] for c in extra])
        out.setdefault(r["query_id"], []).append(entry if extra else r["item_id"])
    return out


def best(scores: dict, k: int):
    return [i for i, s in sorted(scores.items(), key=lambda e: (-round(e[1], 9), e[0])) if s > -math.inf][:k]


# ------------------------------------------------------------------ running top-k


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from([-math.inf, -1.0, 0.0, 0.25, 0.5, 1.0]), min_size=2, max_size=2), max_size=25),
    st.integers(1, 4),
    st.integers(1, 7),
    st.randoms(use_true_random=False),
)
def test_running_topk_equals_sort(rows, k, chunk, rnd):
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    top = RunningTopK(2, k)
    for at in range(0, len(rows), chunk):
        top.push(np.array(ids[at : at + chunk], np.int64), np.array(rows[at : at + chunk], float).reshape(-1, 2))
    got = top.rows(np.array([7, 8]), 0).to_pylist()
    for q in (0, 1):
        scores = {i: r[q] for i, r in zip(ids, rows, strict=True)}
        mine = [r for r in got if r["query_id"] == 7 + q]
        assert [r["item_id"] for r in mine] == best(scores, k)
        assert sum(r["eligible"] for r in mine) == sum(s > -math.inf for s in scores.values())


def test_topk_per_query(spark):
    rows = [(1, 5, 0.5), (1, 3, 0.5 + 1e-12), (1, 4, 0.9), (2, 1, 0.1)]
    scored = spark.createDataFrame(rows, "query_id long, item_id long, score double")
    assert lists(topk_per_query(scored, 2)) == {1: [4, 3], 2: [1]}


@pytest.mark.parametrize("k", [0, 51, -1])
def test_check_k(k):
    with pytest.raises(ValueError, match="k must be"):
        check_k(k, K.USER_K_MAX)


def test_lookup_keeps_rank(spark):
    top = spark.createDataFrame([(1, 1, 9), (1, 2, 3)], "query_id long, rank int, item_id long")
    texts = spark.createDataFrame([(i, f"u{i}") for i in range(10)], "item_id long, url string")
    rows = lookup(top, texts).orderBy("rank").collect()
    assert [r["url"] for r in rows] == ["u9", "u3"]


# ------------------------------------------------------------------ word overlap


def test_word_overlap_fixture(spark):
    sets = [
        (3, ["river", "stone"], ["copper"]),
        (5, ["river", "stone", "moss"], ["copper", "tin"]),
        (6, [], ["river", "stone"]),
        (9, ["cloud"], []),
    ]
    index = WordOverlapIndex(spark.createDataFrame(sets, "item_id long, directions array<string>, ingr array<string>"))
    asked = spark.createDataFrame([(4, "moss on a river stone", "tin")], "query_id long, directions string, ingredients string")
    # A word counts in its own field only: item 6 has the words of the other one.
    assert lists(index.search(asked, 2), "score") == {4: [(5, 4), (3, 2)]}
    # k beyond the matches: items without a shared word fill up, the smallest id first.
    assert lists(index.search(asked, 10)) == {4: [5, 3, 6, 9]}


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(3)
    words = ["apple", "pies", "bake", "boil", "the", "fish", "oven", "and", "salt", "crème"]
    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, text(rnd.randint(0, 8)), text(rnd.randint(0, 4))) for i in range(17)]
    items[5] = (5, items[4][1], items[4][2])  # exact copies tie
    items[6] = (6, "", "")
    queries = [(100 + i, text(4), text(2)) for i in range(6)] + [(200, "zzz qq", ""), (201, "", "")]
    return (
        spark.createDataFrame(items, "item_id long, directions string, ingr string"),
        spark.createDataFrame(queries, "query_id long, directions string, ingredients string"),
        items,
        queries,
    )


@pytest.mark.parametrize("scan", [None, BLOCKS])
def test_word_overlap_equals_brute_force(corpus, scan):
    items, queries, item_rows, query_rows = corpus
    index = WordOverlapIndex.fit(items)
    found = lists(index.search(queries, 5, scan=scan), "score")
    item_sets = {r["item_id"]: r for r in index.sets.collect()}
    query_sets = {r["query_id"]: r for r in token_sets(queries, "query_id", ["directions", "ingredients"]).collect()}
    for q, qs in query_sets.items():
        scores = {
            i: len(set(s["directions"]) & set(qs["directions"])) + len(set(s["ingr"]) & set(qs["ingredients"]))
            for i, s in item_sets.items()
        }
        assert found[q] == [(i, scores[i]) for i in best(scores, 5)]


def test_word_overlap_storage(corpus, spark, tmp_path):
    items, queries, *_ = corpus
    index = WordOverlapIndex.fit(items)
    index.write(str(tmp_path / "sets"))
    index.write_csv(str(tmp_path / "csv"))
    want = lists(index.search(queries, 4))
    assert lists(WordOverlapIndex.read(spark, str(tmp_path / "sets")).search(queries, 4)) == want
    assert lists(WordOverlapIndex.read_csv(spark, str(tmp_path / "csv")).search(queries, 4)) == want


def test_lemma_table(spark):
    items = spark.createDataFrame([(1, "better geese", "mice"), (2, "", "")], "item_id long, directions string, ingr string")
    lemmas = spark.createDataFrame([("better", "good"), ("mice", "mouse")], "surface string, lemma string")
    rows = token_sets(items, "item_id", ["directions", "ingr"], lemmas=lemmas).orderBy("item_id").collect()
    assert [tuple(r) for r in rows] == [(1, ["geese", "good"], ["mouse"]), (2, [], [])]


@pytest.mark.parametrize("share", [1, 3, 10_000])
def test_large_lemma_table(spark, monkeypatch, share):
    from kindred.operators import dictionary
    from kindred.plans import text_search

    items = spark.createDataFrame([(i, "mice " * (i % 3), None if i == 4 else "geese mice") for i in range(9)] + [(9, "", "")],
                                  "item_id long, directions string, ingr string")
    lemmas = spark.createDataFrame([("mice", "mouse"), ("unseen", "none")], "surface string, lemma string")
    def sets():
        return token_sets(items, "item_id", ["directions", "ingr"], lemmas=lemmas).orderBy("item_id").collect()
    want = sets()
    monkeypatch.setattr(text_search, "MAX_LOOKUP_ROWS", -1)
    monkeypatch.setattr(dictionary, "HOT_SHARE", share)
    assert sets() == want and want[1]["ingr"] == ["geese", "mouse"]


# ------------------------------------------------------------------ tf-idf


def _tfidf_model(texts, max_df=0.8, max_chars=K.MAX_CHAR_FEATURES):
    """Fitted dictionaries and a vectoriser, written out plainly."""
    import re

    def word_grams(t):
        ws = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in K.STOP_WORDS]
        return Counter(ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])])

    def char_grams(t):
        t = re.sub(r"\s\s+", " ", t.lower())
        return Counter(t[i : i + n] for n in (2, 3, 4) for i in range(len(t) - n + 1))

    blocks = []
    for grams, most in ((word_grams, None), (char_grams, max_chars)):
        counts = [grams(t) for t in texts]
        df, cf = Counter(), Counter()
        for c in counts:
            df.update(c.keys())
            cf.update(c)
        kept = [t for t in df if df[t] <= max_df * len(texts)]
        kept = sorted(kept, key=lambda t: (-cf[t], t))[:most]
        blocks.append((grams, {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}))

    def vector(t):
        out = {}
        for b, (grams, idf) in enumerate(blocks):
            w = {g: n * idf[g] for g, n in grams(t).items() if g in idf}
            length = math.sqrt(sum(x * x for x in w.values()))
            out.update({(b, g): x / length for g, x in w.items()})
        return out

    return vector


def _cosine(a, b):
    dot = sum(x * b.get(f, 0.0) for f, x in a.items())
    length = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
    return dot / length if length else 0.0


@pytest.mark.parametrize(("scan", "max_chars"), [(None, 5000), (BLOCKS, 5000), (None, 20)])
def test_tfidf_equals_brute_force(corpus, scan, max_chars):
    items, queries, item_rows, query_rows = corpus
    found = lists(TfidfIndex.fit(items, max_char_features=max_chars).search(queries, 6, scan=scan), "score")
    vector = _tfidf_model([f"{d} {i}" for _, d, i in item_rows], max_chars=max_chars)
    vectors = {i: vector(f"{d} {g}") for i, d, g in item_rows}
    for q, d, g in query_rows:
        scores = {i: _cosine(vector(f"{d}. {g}"), v) for i, v in vectors.items()}
        assert [i for i, _ in found[q]] == best(scores, 6)
        assert [s for _, s in found[q]] == pytest.approx([scores[i] for i, _ in found[q]], abs=1e-9)


def test_tfidf_word_table_too_large_to_broadcast(corpus, monkeypatch):
    from kindred.operators import dictionary
    from kindred.plans import tfidf_search

    items, queries, *_ = corpus
    want = lists(TfidfIndex.fit(items).search(queries, 6))
    monkeypatch.setattr(tfidf_search, "MAX_BROADCAST_BYTES", -1)
    for share in (1, 20, 10_000):  # nothing hot, some hot, everything hot
        monkeypatch.setattr(dictionary, "HOT_SHARE", share)
        assert lists(TfidfIndex.fit(items).search(queries, 6)) == want


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9])
def test_tfidf_frequent_words_travel_and_rare_ones_are_joined(corpus, monkeypatch, share):
    """Lengths are the same whatever part of the dictionary is broadcast, and no pair of a word that was is shuffled."""
    from kindred.plans import tfidf_search

    items = corpus[0]
    docs = items.select("item_id", F.concat_ws(" ", "directions", "ingr").alias("text"))
    index = TfidfIndex.fit(items)
    want = {r["item_id"]: r for r in index.lengths(docs).collect()}
    several, joined = index.words.where("df > 1").count(), []
    terms = int(share * several)

    def join(counts, rest, key, rows_of_key, total, spread_by):
        joined.append((counts.where(F.col(key).isNotNull()).count(), rest.count()))
        return whole(counts, rest, key, rows_of_key, total, spread_by)

    whole = tfidf_search.join_dictionary
    monkeypatch.setattr(tfidf_search, "join_dictionary", join)
    monkeypatch.setattr(tfidf_search, "MAX_BROADCAST_BYTES", 16 * terms)
    found = index.lengths(docs).collect()
    assert len(found) == len(want)
    for r in found:
        assert (r["word"], r["char"]) == pytest.approx((want[r["item_id"]]["word"], want[r["item_id"]]["char"]))
    (rows, rest), = joined
    assert several - terms <= rest <= several
    # What is joined: the words of one document, and the rarest of the others.
    df = sorted(r["df"] for r in index.words.where("df > 1").collect())
    assert rows == index.words.where("df = 1").count() + sum(df[:rest])


def test_large_blocks_are_scored_in_single_precision_first(monkeypatch):
    """The lists equal those in double precision, ties and queries without any feature included."""
    from kindred.operators import scorers

    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]

    def texts(n):
        return [[words[i] for i in (rng.random(rng.integers(0, 12)) ** 2 * len(words)).astype(int)] for _ in range(n)]

    item_words = texts(60) * 2
    items = pa.record_batch({
        "item_id": pa.array(rng.permutation(120), pa.int64()), "word": pa.array(item_words, pa.list_(pa.string())),
        "char": pa.array([" ".join(w) for w in item_words]), "features": pa.array([sorted(set(w)) for w in item_words], pa.list_(pa.string())),
        "word_scale": pa.array(rng.random(60).tolist() * 2), "char_scale": pa.array([0.0, *rng.random(59)] * 2)})
    asked = [sorted({f"w{w}" for w in t} | {f"c{w}" for w in t}) for t in texts(40)]
    queries = pa.table({
        "query_id": pa.array(range(40), pa.int64()), "features": pa.array(asked, pa.list_(pa.string())),
        "weights": pa.array([rng.random(len(a)).tolist() for a in asked], pa.list_(pa.float64()))})
    plain = queries.set_column(1, "features", pa.array([sorted({f[1:] for f in a}) for a in asked], pa.list_(pa.string())))
    for spec, block in ((scorers.TextScoring((1, 2), (2, 4)), queries), (SparseScoring(weighted=False), plain)):
        def run():
            scorer = spec.bind(block)
            (found,) = rank_batches(iter([items]), scorer, 3)
            return scorer, found.sort_by([("query_id", "ascending"), ("score", "descending"), ("item_id", "ascending")]).to_pylist()

        monkeypatch.setattr(scorers, "_NEAR_QUERIES", 1_000)
        double, want = run()
        monkeypatch.setattr(scorers, "_NEAR_QUERIES", 1)
        for cells in (scorers._NEAR_DENSE_CELLS, 0):
            monkeypatch.setattr(scorers, "_NEAR_DENSE_CELLS", cells)
            single, got = run()
            assert not double.near and single.near and single.dense.dtype == np.float32
            assert len(got) == len(want) == 120
            for x, y in zip(got, want, strict=True):
                assert (x["query_id"], x["item_id"], x["eligible"]) == (y["query_id"], y["item_id"], y["eligible"])
                assert x["score"] == pytest.approx(y["score"], rel=1e-12)
        monkeypatch.undo()


def test_groups_of_like_queries_give_the_same_lists(monkeypatch):
    """Texts of two kinds, grouped by frequent features, long and short: the lists equal those in double precision."""
    from kindred.operators import scorers

    rng = np.random.default_rng(8)
    def table(n, key):
        texts = [[f"{'ab'[i % 2]}{int(w)}" for w in rng.random(rng.integers(0, 30)) ** 2 * 40] for i in range(n)]
        return pa.table({key: pa.array(rng.permutation(n), pa.int64()), "features": pa.array(texts, pa.list_(pa.string()))})
    items, queries = table(150, "item_id"), table(64, "query_id")
    def run():
        scorer = SparseScoring(weighted=False).bind(queries)
        (found,) = rank_batches(iter(items.to_batches(max_chunksize=70)), scorer, 4)
        return scorer, found.sort_by([("query_id", "ascending"), ("score", "descending"), ("item_id", "ascending")]).to_pylist()
    _, want = run()
    monkeypatch.setattr(scorers, "_NEAR_QUERIES", 1)
    monkeypatch.setattr(scorers, "_NEAR_GROUP", 8)
    monkeypatch.setattr(scorers, "_NEAR_CELLS", 64 * 20)
    grouped, got = run()
    assert len(grouped.groups.slices) > 2 and sum(len(c) for c in grouped.groups.columns) and len(grouped.groups.lists)
    assert got == want and len(want) == 4 * 64


@pytest.mark.parametrize("way", ["plain", "demoted", "band", "edges", "limits"])
def test_large_blocks_of_vectors_are_scored_in_single_precision_first(monkeypatch, way):
    """The lists and counts equal those in double precision: copies, vectors of zeros and ends of the band included."""
    from kindred.operators import range_grid, scorers

    rng = np.random.default_rng(3)
    def vectors(n):
        out = rng.normal(size=(n, 3)).round(1)
        out[rng.random(n) < 0.1] = 0.0
        out[rng.random(n) < 0.2] = [1.0, 0.0, 1.0]
        return out
    def table(n, key):
        return pa.table({key: pa.array(rng.permutation(n), pa.int64()), "embedding": pa.array(vectors(n).tolist(), pa.list_(pa.float64())),
                         "kind": pa.array(rng.choice(["x", "y", None], n).tolist(), pa.string()), "a": pa.array([None if a < 0.1 else a for a in rng.random(n)])})
    items, queries = table(300, "item_id"), table(50, "query_id")
    if way == "limits":
        limits = range_grid.QueryLimits(ranges=(("a", "low", None),), method=("kind", "kinds"))
        queries = queries.append_column("low", pa.array([None if a < 0.2 else a for a in rng.random(50)]))
        queries = queries.append_column("kinds", pa.array([["x"]] * 25 + [[]] * 25)).append_column("_every_method", pa.array([False] * 25 + [True] * 25))
        spec = DenseScoring(demote=0.98, limits=limits)
    else:
        # Vectors (1, 0, 1) and (1, 0, 0) stand at the square root of a half.
        ends = {"band": (0.2, 0.9), "edges": (0.5**0.5, 1.0)}.get(way)
        facets = (("kind", "kind"), ("a", "a")) if way == "band" else ()
        spec = DenseScoring(demote=0.98 if way == "demoted" else None, band=ends, facets=facets, weight=0.6)
    def run(k):
        scorer = spec.bind(queries)
        found = [sorted(b.to_pylist(), key=lambda r: (r["query_id"], -round(r["score"], 9), r["item_id"]))
                 for b in rank_batches(iter(items.to_batches(max_chunksize=130)), scorer, k)]
        return scorer, found
    for k in (1, 7):
        double, want = run(k)
        monkeypatch.setattr(scorers, "_NEAR_QUERIES", 1)
        monkeypatch.setattr(scorers, "_COSINE_CELLS", 50 * 25)
        single, got = run(k)
        monkeypatch.undo()
        assert not double.near and single.near
        enough = {r["query_id"] for r in want[0] if r["eligible"] >= k}
        if spec.band:  # who has enough inside the band needs no other list
            lists = [{r["query_id"] for r in found[1]} for found in (want, got)]
            assert lists[0] - enough <= lists[1]
            want[1], got[1] = ([r for r in found[1] if r["query_id"] not in enough] for found in (want, got))
        for mine, theirs in zip(got, want, strict=True):
            same = [[(r["query_id"], r["item_id"], r["eligible"]) for r in found] for found in (mine, theirs)]
            assert same[0] == same[1]
            assert [r["score"] for r in mine] == pytest.approx([r["score"] for r in theirs], abs=1e-12)


def test_tfidf_storage(corpus, spark, tmp_path):
    items, queries, *_ = corpus
    index = TfidfIndex.fit(items)
    index.write(str(tmp_path / "tfidf"))
    loaded = TfidfIndex.read(spark, str(tmp_path / "tfidf"))
    assert lists(loaded.search(queries, 4), "score") == lists(index.search(queries, 4), "score")
    assert loaded.texts.count() == items.count()


@pytest.mark.parametrize("k", [1, 3, 6])
def test_tfidf_gives_k_rows(spark, k):
    rows = [(i, f"stone {w}", w[::-1]) for i, w in enumerate(["river", "cloud", "copper", "moss", "tin", "sand"])]
    items = spark.createDataFrame(rows, "item_id long, directions string, ingr string")
    asked = spark.createDataFrame([(8, "a moss stone", "no"), (9, "", "")], "query_id long, directions string, ingredients string")
    found = lists(TfidfIndex.fit(items).search(asked, k))
    assert {q: len(ids) for q, ids in found.items()} == {8: k, 9: k} and found[8][0] == 3


# ------------------------------------------------------------------ vectors


def _vectors(spark, rows, key="item_id"):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], f"{key} long, embedding array<float>")


def _unit(similarity):
    """A vector whose cosine to (1, 0) is the given one."""
    return [similarity, math.sqrt(1 - similarity * similarity)]


@pytest.mark.parametrize(
    ("ids", "k", "similarities", "expected"),
    [
        ([5], 1, [0.25], [5]),
        ([5, 2], 4, [0.25, 0.3], [2, 5]),  # fewer candidates than k
        ([1, 3, 5], 2, [-0.5, 0.1, 0.0], [3, 5]),
        ([4, 0], 2, [0.995, -0.9], [0, 4]),  # a near copy goes last
        ([3, 1, 2], 3, [0.5, 0.5, 0.5], [1, 2, 3]),
    ],
)
def test_restricted_search(spark, ids, k, similarities, expected):
    everything = dict(zip(ids, map(_unit, similarities), strict=True))
    rows = [(i, everything.get(i, [1.0, 0.0])) for i in range(6)]
    index = EmbeddingIndex(_vectors(spark, rows))
    kept = spark.createDataFrame([(i,) for i in ids], "item_id long")
    found = index.search(_vectors(spark, [(9, [1, 0])], "query_id"), k, candidates=kept)
    assert lists(found) == {9: expected}


def test_zero_and_missing_vectors_score_zero(spark):
    items = spark.createDataFrame([(0, [0.0, 0.0]), (1, None), (2, [0.0, 1.0]), (3, [-1.0, 0.0])],
                                  "item_id long, embedding array<float>")
    found = lists(EmbeddingIndex(items).search(_vectors(spark, [(9, [1, 0])], "query_id"), 4), "score")
    assert found == {9: [(0, 0.0), (1, 0.0), (2, 0.0), (3, -1.0)]}


def test_fields_are_laid_side_by_side(spark):
    def factory():
        return lambda texts: np.array([[len(t), t.count("a"), 9] for t in texts])

    items = spark.createDataFrame([(0, "aba", "c"), (1, "", None)], "item_id long, directions string, ingr string")
    both = embed(items, "item_id", ["directions", "ingr"], factory)
    rows = both.orderBy("item_id").collect()
    assert [r["embedding"] for r in rows] == [[3, 2, 9, 1, 0, 9], [0, 0, 9, 0, 0, 9]]
    assert embed(items, "item_id", ["ingr"], factory).where("item_id = 0").first()["embedding"] == [1, 0, 9]
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_model_is_loaded_once_per_process(spark, tmp_path):
    import os
    import uuid

    def factory():
        (tmp_path / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda texts: np.ones((len(texts), 1))

    for _ in range(2):
        rows = spark.range(40).select(F.col("id").alias("item_id"), F.lit("x").alias("a"), F.lit("y").alias("b"))
        assert embed(rows.repartition(8), "item_id", ["a", "b"], factory).where("embedding[1] = 1").count() == 40
    loads = [f.name.split("-")[0] for f in tmp_path.iterdir()]
    assert loads and len(loads) == len(set(loads))


def test_texts_are_encoded_and_counted_by_bounded_parts(spark, monkeypatch):
    """A batch of 2500 texts is unfolded in parts, with the same results as a whole."""
    from kindred.functions import models, ngrams

    def factory():
        def encode(texts):
            assert len(texts) <= 1000
            return np.array([[float(len(t))] for t in texts])
        return encode

    table = spark.range(0, 2500, 1, 1).select("id", F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    found = table.select("id", models.encode_fields([F.col("text")], factory).alias("v")).collect()
    assert [r.v for r in found] == [[r.id % 50] for r in found] and len(found) == 2500

    sizes, count = [], ngrams.char_ngrams
    monkeypatch.setattr(ngrams, "char_ngrams", lambda texts, *n: (sizes.append(len(texts)), count(texts, *n))[1])
    batch = pa.record_batch({"char": pa.array(["ab", "abc"] * 1250)})
    parts = pa.Table.from_batches(ngrams.frequency_mapper(None, (2, 2))(iter([batch]))).to_pylist()
    counts = Counter()
    for r in parts:
        counts[r["term"]] += r["df"]
    assert max(sizes) <= 1000 and counts == {"ab": 2500, "bc": 1250}


def test_embedding_storage(spark, tmp_path):
    index = EmbeddingIndex(_vectors(spark, [(i, _unit(i / 10)) for i in range(5)]))
    index.write(str(tmp_path / "v"))
    asked = _vectors(spark, [(9, [1, 0])], "query_id")
    assert lists(EmbeddingIndex.read(spark, str(tmp_path / "v")).search(asked, 3)) == lists(index.search(asked, 3))


@pytest.fixture(scope="module")
def faceted(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(3)), str(rng.integers(2))) for i in range(40)]
    rows[7] = (7, rows[6][1], None, None)  # a copy without facets
    asked = [(i, v, a, b) for i, v, a, b in rows[:9]]
    return (
        spark.createDataFrame(rows, "item_id long, embedding array<double>, a int, b string"),
        spark.createDataFrame(asked, "query_id long, embedding array<double>, a int, b string"),
        rows,
        asked,
    )


def _sim(u, v):
    return float(np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v))


@pytest.mark.parametrize("scan", [None, BLOCKS])
@pytest.mark.parametrize("band", [(0.2, 0.95), (0.6, 0.9), (0.99999, 0.999999)])
def test_blended_equals_brute_force(faceted, scan, band):
    items, queries, rows, asked = faceted
    found = lists(EmbeddingIndex(items).search_blended(queries, ["a", "b"], 6, band, scan=scan), "score", "branch")
    branches = set()
    for q, qv, qa, qb in asked:
        similarity = {i: _sim(qv, v) for i, v, _, _ in rows}
        inside = {
            i: 0.6 * similarity[i] + 0.4 * ((a is not None and a == qa) + (b is not None and b == qb)) / 2
            for i, v, a, b in rows
            if band[0] <= similarity[i] <= band[1]
        }
        scores, branch = (inside, "band") if len(inside) >= 6 else (similarity, "fallback")
        branches.add(branch)
        assert [i for i, _, _ in found[q]] == best(scores, 6)
        assert {b for _, _, b in found[q]} == {branch}
        assert [s for _, s, _ in found[q]] == pytest.approx([scores[i] for i, _, _ in found[q]])
    assert branches  # both branches occur over the parametrised bands


def test_blended_fixture(spark):
    # The less similar item shares more facets and wins; the third lies above the band.
    items = spark.createDataFrame(
        [(2, _unit(0.93), 7, "p"), (4, _unit(0.82), 8, "q"), (6, _unit(0.97), 8, "q")],
        "item_id long, embedding array<double>, size int, kind string",
    )
    asked = spark.createDataFrame([(1, [2.0, 0.0], 8, "q")], "query_id long, embedding array<double>, size int, kind string")
    index = EmbeddingIndex(items)
    found = lists(index.search_blended(asked, ["size", "kind"], 2), "score")[1]
    assert [i for i, _ in found] == [4, 2]
    assert [s for _, s in found] == pytest.approx([0.6 * 0.82 + 0.4, 0.6 * 0.93])
    assert lists(index.search_blended(asked, ["size", "kind"], 3), "branch") == {1: [(i, "fallback") for i in (6, 2, 4)]}
    with pytest.raises(ValueError, match="filter_features cannot be None"):
        index.search_blended(asked, None)


def test_item_as_its_own_query(faceted):
    items, _, rows, _ = faceted
    asked = items.withColumnRenamed("item_id", "query_id")
    index = EmbeddingIndex(items)
    plain = lists(index.search(asked, 1, demote=None))
    assert all(found == [6 if q == 7 else q] for q, found in plain.items())
    demoted = lists(index.search(asked, len(rows), demote=0.98), "score")
    assert all((q, -1.0) in found[-2:] for q, found in demoted.items())


# ------------------------------------------------------------------ the two ways to meet


def test_query_size_counts_every_column(spark):
    rows = spark.createDataFrame(
        [(1, "é", ["ab", None], [1.0, 2.0]), (2, None, None, None)],
        "query_id long, text string, features array<string>, weights array<double>",
    )
    assert table_size(rows) == (2, (8 + 2 + 10 + 8 + 16) + 8)


def test_blocks_and_one_broadcast_agree_on_sparse(spark):
    rnd = random.Random(1)
    def rows(n, key):
        data = []
        for i in range(n):
            names = rnd.sample("abcdefgh", rnd.randint(0, 5))
            data.append((i, names, [rnd.random() for _ in names]))
        return spark.createDataFrame(data, f"{key} long, features array<string>, weights array<double>")
    items, queries = rows(60, "item_id"), rows(11, "query_id")
    def run(**options):
        return lists(ranked(merge_topk(scan_topk(items, queries, SparseScoring(), 7, **options), 7)), "score")
    one, two, three = run(), run(max_rows=2), run(max_bytes=200)
    for q, found in one.items():
        for other in (two, three):
            assert [i for i, _ in other[q]] == [i for i, _ in found]
            assert [s for _, s in other[q]] == pytest.approx([s for _, s in found])


def test_dense_product_for_frequent_features(monkeypatch):
    from kindred.operators import scorers

    rng = np.random.default_rng(2)
    names = [f"f{i}" for i in range(30)]
    def table(n, key):
        picks = [sorted(rng.choice(30, rng.integers(0, 9), replace=False).tolist()) for _ in range(n)]
        return pa.table({key: pa.array(range(n), pa.int64()),
                         "features": pa.array([[names[p] for p in x] for x in picks], pa.list_(pa.string())),
                         "weights": pa.array([rng.random(len(x)).tolist() for x in picks], pa.list_(pa.float64()))})
    items, queries = table(50, "item_id"), table(40, "query_id")
    def run():
        scorer = SparseScoring().bind(queries)
        return scorer, [b.to_pylist() for b in rank_batches(iter(items.to_batches()), scorer, 5)]
    with_dense, a = run()
    monkeypatch.setattr(scorers, "_DENSE_CELLS", 0)
    monkeypatch.setattr(scorers, "_CELLS", 50)
    without, b = run()
    assert len(with_dense.dense) > 0 and len(without.dense) == 0
    for x, y in zip(a[0], b[0], strict=True):
        assert (x["query_id"], x["item_id"]) == (y["query_id"], y["item_id"])
        assert x["score"] == pytest.approx(y["score"])


def test_no_queries_and_no_items(spark):
    items, none = _vectors(spark, [(0, [1, 0])]), _vectors(spark, [], "query_id")
    assert lists(EmbeddingIndex(items).search(none, 3)) == {}
    assert lists(EmbeddingIndex(_vectors(spark, [])).search(_vectors(spark, [(1, [1, 0])], "query_id"), 3)) == {}


def test_several_blocks_make_the_items_once(spark, monkeypatch):
    """No pass encodes or joins the items anew, and no caller gets blocks above what may be broadcast."""
    from kindred.operators import scan

    made, shared = spark.sparkContext.accumulator(0), scan._shared
    sizes = []

    @F.udf("array<double>")
    def vector(i):
        made.add(1)
        return [float(i), 1.0]

    monkeypatch.setattr(scan, "MAX_BROADCAST_ROWS", 4)
    monkeypatch.setattr(scan, "_shared", lambda block: (sizes.append(block.count()), shared(block))[1])
    items = spark.range(30).select(F.col("id").alias("item_id"), vector("id").alias("embedding"))
    asked = spark.range(20).selectExpr("id AS query_id", "array(double(id), 2.0D) AS embedding")
    found = ranked(merge_topk(scan_topk(items, asked, DenseScoring(), 3, max_rows=1000), 3))
    assert found.count() == 60 and made.value == 30
    assert len(sizes) >= 5 and max(sizes) < 20


def test_steps_of_a_scan_are_bounded():
    """A few queries over a large batch: the scores and the dense product of a step stay small."""
    queries = pa.table({"query_id": pa.array([1, 2], pa.int64()), "features": pa.array([["a"], ["b"]], pa.list_(pa.string()))})
    scorer, steps = SparseScoring(weighted=False).bind(queries), []
    score = scorer.score
    scorer.score = lambda batch: (steps.append(batch.num_rows), score(batch))[1]
    batch = pa.record_batch({"item_id": pa.array(range(9000), pa.int64()), "features": pa.array([["a", "c"]] * 9000, pa.list_(pa.string()))})
    found = [r for b in rank_batches(iter([batch]), scorer, 3) for r in b.to_pylist()]
    assert max(steps) <= 2000 and sum(steps) == 9000
    assert [(r["query_id"], r["item_id"], r["score"]) for r in found] == [(1, 0, 1.0), (1, 1, 1.0), (1, 2, 1.0), (2, 0, 0.0), (2, 1, 0.0), (2, 2, 0.0)]


def test_plan_has_no_cross_join_and_no_item_shuffle(spark, faceted, tmp_path):
    items, queries, *_ = faceted
    items.write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    partials = scan_topk(stored, queries, DenseScoring(), 3)
    plan = partials._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<item_id:bigint,embedding:array<double>>" in plan


@pytest.mark.parametrize("rows", [[], [(0, "bake a pie", "salt")], [(0, "bake", "salt"), (1, "bake", "salt")]])
def test_tfidf_of_tiny_corpora(spark, rows):
    """max_df leaves no feature here; items still come back, at score 0."""
    items = spark.createDataFrame(rows, "item_id long, directions string, ingr string")
    asked = spark.createDataFrame([(5, "bake", "salt"), (6, "", "")], "query_id long, directions string, ingredients string")
    found = lists(TfidfIndex.fit(items).search(asked, 3), "score")
    want = [(i, 0.0) for i, _, _ in rows]
    assert found == ({5: want, 6: want} if rows else {})


def test_a_third_of_the_items_are_copies(spark):
    """Ties by the hundred at the top, in every task: the smallest ids win, whatever the split."""
    copies = spark.range(3000).select(
        F.col("id").alias("item_id"),
        F.when(F.col("id") % 3 == 1, "bake the apple pie").otherwise(F.concat(F.lit("boil water w"), "id")).alias("directions"),
        F.lit("salt").alias("ingr"),
    ).repartition(8, "directions")
    asked = spark.createDataFrame([(1, "apple pie", "salt"), (2, "boil", "salt")], "query_id long, directions string, ingredients string")
    words = WordOverlapIndex.fit(copies)
    tfidf = TfidfIndex.fit(copies)
    want = {1: [1, 4, 7, 10], 2: [0, 2, 3, 5]}
    for scan in (None, {"max_rows": 1}):
        assert lists(words.search(asked, 4, scan=scan)) == want
        assert lists(tfidf.search(asked, 4, scan=scan))[1] == want[1]

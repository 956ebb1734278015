"""Word-overlap search over an inverted index: only the postings of the queries' own words are read.

The index holds one row per (field, token, item), in folders by a hash of the token and sorted by it, and a table
of document frequencies. A search goes from rare words to common ones, in rounds. After a round, an item that no
word has found so far shares at most the words still to come. Once a query's k-th best count is above that number, no
other item can enter its list and the query leaves the rounds: the postings of its common words are not read.

Counts so far are lower bounds, so the items that can still reach the list are scored exactly, from their token sets,
before the list is cut. Every step is a join on equal columns or an aggregation. Postings are dealt by item before they meet
the queries, into parts whose pairs with all queries are a bounded number: a task that read the postings of a common word
whole would count a pair for most items and queries.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.tokens import word_overlap
from kindred.operators.topk import check_k, topk_per_query
from kindred.plans.text_search import QUERY_FIELDS, TEXT_FIELDS, token_sets
from kindred.shared import scratch, stored

BUCKETS = 64  # folders of the postings
# Words of a round stand in at most this share of the items; the last round takes them all.
ROUNDS = (0.001, 0.03, 1.0)
POSTINGS = "item_id bigint, field int, token string, bucket int"
COUNTERS = 2_000_000  # pairs of query and item that a task counts, at most about
MAX_TASKS = 4096
MAX_PUSHED = 500  # so many tokens are named to the scan; more are found by the join alone


def bucket_of(token: str = "token") -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def each_token(sets: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, token): one row per word of a set; fields are numbered."""
    numbered = F.array(*[
        F.struct(F.lit(i).alias("field"), F.coalesce(F.col(f), F.array().cast("array<string>")).alias("tokens"))
        for i, f in enumerate(fields)
    ])
    parts = sets.select(key, F.explode(numbered).alias("f")).select(key, "f.field", F.explode("f.tokens").alias("token"))
    return parts


@dataclass(frozen=True)
class PostingsIndex:
    """postings (field, token, item_id, bucket), terms (field, token, df), and the sets they were made of."""

    postings: DataFrame
    terms: DataFrame
    sets: DataFrame
    fields: tuple[str, ...] = TEXT_FIELDS

    @classmethod
    def fit(cls, items: DataFrame, path: str, fields: Sequence[str] = TEXT_FIELDS, **options) -> PostingsIndex:
        """Build the index in a folder. Item ids are whole numbers, each once."""
        spark = items.sparkSession
        token_sets(items, "item_id", fields, **options).write.parquet(f"{path}/sets")
        sets = spark.read.parquet(f"{path}/sets")
        postings = each_token(sets, "item_id", fields).withColumn("bucket", bucket_of())
        # A hot word makes a large folder of several files and no large task.
        dealt = postings.repartition("bucket", F.pmod(F.xxhash64("item_id"), F.lit(4)))
        dealt.sortWithinPartitions("bucket", "field", "token").write.partitionBy("bucket").parquet(f"{path}/postings")
        written = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
        written.groupBy("field", "token").agg(F.count("*").alias("df")).write.parquet(f"{path}/terms")
        return cls.read(spark, path, fields)

    @classmethod
    def read(cls, spark: SparkSession, path: str, fields: Sequence[str] = TEXT_FIELDS) -> PostingsIndex:
        kinds = {"postings": POSTINGS, "terms": "field int, token string, df bigint",
                 "sets": "item_id bigint, " + ", ".join(f"{f} array<string>" for f in fields)}
        return cls(*[spark.read.schema(kind).parquet(f"{path}/{name}") for name, kind in kinds.items()], tuple(fields))

    def postings_of(self, asked: DataFrame) -> DataFrame:
        """The postings of the (field, token) pairs of a table; folders of other words are not opened."""
        words = asked.select("token").distinct()
        buckets = [r[0] for r in words.select(bucket_of().alias("b")).distinct().collect()]  # at most BUCKETS numbers
        rows = self.postings.where(F.col("bucket").isin(buckets))
        named = [r[0] for r in words.limit(MAX_PUSHED + 1).collect()]
        return rows.where(F.col("token").isin(named)) if len(named) <= MAX_PUSHED else rows

    def search(
        self, queries: DataFrame, k: int = K.DEFAULT_K, query_fields: Sequence[str] = QUERY_FIELDS,
        rounds: Sequence[float] = ROUNDS, report: list | None = None, **options: Mapping,
    ) -> DataFrame:
        """(query_id, rank, item_id, score); items without a shared word fill up at score 0, smallest ids first.

        ``report`` gets (share of items, queries answered, items counted) of every round.
        """
        check_k(k)
        with scratch(queries.sparkSession) as keep:
            wanted = stored(token_sets(queries, "query_id", query_fields, **options), "wanted")
            asked = stored(each_token(wanted, "query_id", query_fields).join(self.terms, ["field", "token"]), "asked")
            n = self.sets.count()
            chosen = []
            still, counted = wanted.select("query_id"), None
            lower = 0
            for share in rounds:
                upper = n if share >= 1 else int(share * n)
                mine = asked.join(still, "query_id", "left_semi")
                new = mine.where((F.col("df") > lower) & (F.col("df") <= upper))
                least = queries.sparkSession.sparkContext.defaultParallelism
                tasks = max(least, min(MAX_TASKS, math.ceil(n * still.count() / COUNTERS)))
                dealt = self.postings_of(new).repartition(tasks, "item_id")
                hits = dealt.join(new.select("query_id", "field", "token"), ["field", "token"])
                pairs = hits.groupBy("query_id", "item_id").agg(F.count("*").cast("int").alias("score"))
                if counted is not None:
                    both = pairs.unionByName(counted.join(still, "query_id", "left_semi")).repartition(tasks, "query_id", "item_id")
                    pairs = both.groupBy("query_id", "item_id").agg(F.sum("score").cast("int").alias("score"))
                counted = stored(pairs, "counted")
                rest = mine.groupBy("query_id").agg(F.count_if(F.col("df") > upper).alias("rest"))
                bars = topk_per_query(counted, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("bar"))
                # A query without any known word has nothing to come and no bar.
                state = still.join(rest, "query_id", "left").join(bars, "query_id", "left").na.fill(0)
                done = stored(state.where((F.col("rest") == 0) | (F.col("bar") > F.col("rest"))), "done")
                open_end = F.col("score") + F.col("rest") >= F.col("bar")
                chosen.append(stored(counted.join(done, "query_id").where(open_end).select("query_id", "item_id"), "chosen"))
                if report is not None:
                    report.append((share, done.count(), counted.count()))
                still = stored(still.join(done, "query_id", "left_anti"), "still")
                lower = upper
                if still.isEmpty():
                    break
            found = chosen[0]
            for part in chosen[1:]:
                found = found.union(part)
            top = topk_per_query(self._scored(found, wanted, query_fields), k)
            return keep(self._filled(top, wanted.select("query_id"), k), "word-overlap")

    def _scored(self, pairs: DataFrame, wanted: DataFrame, query_fields: Sequence[str]) -> DataFrame:
        """Exact counts of some (query, item) pairs, from the sets of both."""
        mine = wanted.select("query_id", *[F.col(f).alias(f"_{i}") for i, f in enumerate(query_fields)])
        sides = [F.col(f) for f in self.fields], [F.col(f"_{i}") for i in range(len(query_fields))]
        empty = F.array().cast("array<string>")
        shared = word_overlap(*[[F.coalesce(c, empty) for c in side] for side in sides])
        return pairs.join(mine, "query_id").join(self.sets, "item_id").select("query_id", "item_id", shared.cast("bigint").alias("score"))

    def _filled(self, top: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        """Lists shorter than k are filled up: of the 2k smallest ids, at least k are not yet in a list."""
        ids = [r[0] for r in self.sets.select("item_id").orderBy("item_id").limit(2 * k).collect()]
        short = queries.join(top.groupBy("query_id").agg(F.count("*").alias("have")), "query_id", "left").na.fill(0).where(F.col("have") < k)
        more = short.select("query_id", F.explode(F.array(*map(F.lit, ids)).cast("array<bigint>")).alias("item_id"))
        more = more.join(top, ["query_id", "item_id"], "left_anti").withColumn("score", F.lit(0).cast("bigint"))
        whole = top.select("query_id", "item_id", "score").unionByName(more.select("query_id", "item_id", "score"))
        return topk_per_query(whole, k).select("query_id", "rank", "item_id", "score")

"""Rendezvous hashing of stable record keys over weighted shards.

A row goes to the shard with the smallest exponential score ``-ln(u) / weight``, where ``u`` is a hash
of key and shard number. Scores of the old shards do not change when one is added, so a new shard only
takes rows into itself, about its share of the weights.

Defined cases: a NULL key counts as the empty key; rows of one key share a shard; a NULL text has no
bytes; identical rows take neighbouring slots in any order. Columns other than key and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.texts import let
from kindred.shared import stored

SHARDS = 24
ROW_OVERHEAD = 8
HASH_BITS = 52
PARTS = 16**3  # of a shard
HOT_SHARE = 2000


def unit_hash(text: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of a string."""
    digits = F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))


def scores(key: Column, weights: Sequence[float]) -> Column:
    """One score per shard; the smallest wins."""
    named = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/"))
    return F.transform(
        F.array(*[F.lit(float(w)) for w in weights]),
        lambda weight, shard: -F.log(unit_hash(F.concat(named, shard.cast("string")))) / weight,
    )


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    return let(scores(key, weights), lambda found: (F.array_position(found, F.array_min(found)) - 1).cast("int"))


def _frequent(rows: DataFrame) -> DataFrame:
    """``_name`` of the rows that make up more than 1 / HOT_SHARE of the table, so never more than HOT_SHARE of them."""
    names = rows.groupBy("_name").agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*").alias("_all"))
    return names.where(F.col("_n") > 1).join(F.broadcast(total), F.col("_n") * HOT_SHARE > F.col("_all")).select("_name")


def assign(
    docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * SHARDS,
    new_weight: float = 1.0,
) -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard``; ``grown_shard`` is the place after one more shard.

    Slots number the rows of a shard from 0 without gaps. A shard is counted and numbered in 4096 parts
    by a hash of the row, so no task holds a whole shard; only the parts' counts are summed per shard. Rows
    that stand there very often, equal in key, size and text, are dealt over all parts.
    """
    old = len(weights)
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")

    def places(found: Column) -> Column:
        before = F.slice(found, 1, old)
        best = F.array_min(before)
        shard = (F.array_position(before, best) - 1).cast("int")
        return F.struct(
            shard.alias("shard"), F.when(F.get(found, F.lit(old)) < best, F.lit(old)).otherwise(shard).alias("grown_shard")
        )

    size = (F.length(body) + ROW_OVERHEAD).cast("long")
    rows = docs.select(
        F.col(key).alias("_key"), size.alias("size"), F.crc32(body).alias("text_crc32"),
        F.inline(F.array(let(scores(F.col(key), [*weights, new_weight]), places))),
    )
    row_name = F.concat_ws("#", F.coalesce(F.col("_key").cast("string"), F.lit("")), "size", "text_crc32")
    # Stored, so that a row keeps its number whatever reads it.
    rows = stored(rows.withColumns({"_name": F.md5(row_name), "_at": F.monotonically_increasing_id()}), "shards")
    often = F.broadcast(_frequent(rows).withColumn("_often", F.lit(True)))
    anywhere = F.lower(F.lpad(F.hex(F.pmod(F.xxhash64("_at"), F.lit(PARTS))), 3, "0"))
    part = F.when(F.col("_often"), anywhere).otherwise(F.substring("_name", 1, 3))
    rows = rows.join(often, "_name", "left").withColumn("_part", part)

    parts = rows.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))

    order = Window.partitionBy("shard", "_part").orderBy("_key", "size", "text_crc32")
    numbered = rows.withColumn("_row", F.row_number().over(order)).join(offsets, ["shard", "_part"])
    return numbered.select(
        F.col("_key").alias(key), "size", "text_crc32", "shard",
        (F.col("_offset") + F.col("_row") - 1).cast("long").alias("slot"), "grown_shard",
    )

"""Dictionaries of distinct values: skew-safe joins against them, and label codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.shared import MAX_LOOKUP_ROWS, stored

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are never
# more than HOT_SHARE hot keys: a proven bound for the broadcast.
HOT_SHARE = 10_000


def join_dictionary(
    rows: DataFrame, dictionary: DataFrame, key: str, rows_of_key: str, total: int, spread_by: str
) -> DataFrame:
    """Left join on ``key`` in which no key meets more than 1/HOT_SHARE of the rows in a task.

    Hot keys are looked up in a broadcast. Their rows, and those without a key, then carry a
    spread number the cold side does not have, so the shuffle deals them out evenly.
    """
    values = [c for c in dictionary.columns if c != key]
    packed = dictionary.withColumn("value", F.struct(*values)).withColumn(
        "is_hot", F.col(rows_of_key) * F.lit(HOT_SHARE) > F.lit(total)
    )
    hot = packed.where("is_hot").select(key, F.col("value").alias("hot"))
    # Always 0, but computed from the key: a literal would be folded out of the join keys.
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    cold = packed.where(~F.col("is_hot")).select(key, F.col("value").alias("cold"), zero.alias("spread"))
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "spread",
        F.when(F.col("hot").isNull() & F.col(key).isNotNull(), 0).otherwise(1 + F.pmod(F.xxhash64(spread_by), F.lit(4096)).cast("int")),
    )
    joined = marked.join(cold, [key, "spread"], "left")
    value = F.coalesce("hot", "cold")
    return joined.select(
        *rows.columns, *[value.getField(v).alias(v) for v in values if v not in rows.columns]
    )


def join_counted(rows: DataFrame, dictionary: DataFrame, key: str, spread_by: str) -> DataFrame:
    """The same for a dictionary that does not know how many rows a key has: they are counted first."""
    counts = stored(rows.groupBy(key).agg(F.count("*").alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    return join_dictionary(rows, dictionary.join(counts, key), key, "_rows", total, spread_by).drop("_rows")


def numbered(values: DataFrame, column: str) -> DataFrame:
    """(value, code): sorted distinct values numbered 0..n-1 without a one-task sort."""
    parts = stored(
        values.select(column)
        .repartitionByRange(F.col(column))
        .withColumn("part", F.spark_partition_id()),
        "numbered",
    )
    # One row per partition, so this window is small whatever the data.
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("part").orderBy(column))
    return parts.join(F.broadcast(offsets), "part").select(
        column, (place - 1 + F.col("offset")).cast("int").alias("code")
    )


def label_dictionary(df: DataFrame, columns: Sequence[str], small: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """(column, label, n, code): codes 0..n-1 by sorted label, one numbering per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in columns])
    counted = stored(
        df.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("label").isNotNull())
        .groupBy("column", "label")
        .agg(F.count("*").alias("n")),
        "labels",
    )
    if counted.count() <= small:
        code = F.row_number().over(W.partitionBy("column").orderBy("label")) - 1
        return counted.withColumn("code", code)
    out = None
    for column in columns:
        one = counted.where(F.col("column") == column)
        coded = one.join(numbered(one, "label"), "label").select("column", "label", "n", "code")
        out = coded if out is None else out.unionByName(coded)
    return stored(out, "label-codes")


def encode_labels(
    df: DataFrame, columns: Sequence[str], spread_by: str = "item_id", small: int = MAX_LOOKUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Replace label columns by their codes; the dictionary is returned beside it."""
    dictionary = label_dictionary(df, columns, small)
    is_small = dictionary.count() <= small
    total = None if is_small else df.count()
    out = df
    for column in columns:
        codes = dictionary.where(F.col("column") == column).select(
            F.col("label").alias(column), F.col("code").alias("_code"), F.col("n").alias("_n")
        )
        if is_small:
            out = out.join(F.broadcast(codes.drop("_n")), column, "left")
        else:
            out = join_dictionary(out, codes, column, "_n", total, spread_by)
        out = out.withColumn(column, F.col("_code")).drop("_code", "_n")
    return out.select(*df.columns), dictionary

"""The driver tables seen as the tables of a similarity corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.shared import spread
from kindred.sources.tables import read_table


# Declared, so that no job is spent on reading footers for a schema.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly to work on: spread over the cores."""
    return spread(table(spark, sf_dir, name), key)


def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items: their own columns and what their lines say as facets."""
    def any_line(condition) -> F.Column:
        return F.max(condition.cast("int"))

    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(
        (F.count("*") * 5.0).alias("protein"),
        F.max("l_quantity").alias("fat"),
        (F.max("l_discount") * 1000).alias("carbs"),
        F.max("l_linestatus").alias("course"),
        any_line(F.col("l_returnflag") == "A").alias("vegetables"),
        any_line(F.col("l_returnflag") == "N").alias("fruits"),
        any_line(F.col("l_returnflag") == "R").alias("meat"),
        any_line(F.col("l_linestatus") == "O").alias("seafood"),
        any_line(F.col("l_tax") == 0).alias("mushrooms"),
        any_line(F.col("l_discount") == 0).alias("dairy"),
        any_line(F.col("l_quantity") < 5).alias("grains"),
        any_line(F.col("l_quantity") > 45).alias("nuts"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_totalprice").alias("calories"),
        F.col("o_orderstatus").alias("meal"),
        F.col("o_orderpriority").alias("cooking_methods"),
        F.dayofyear("o_orderdate").alias("time_mins"),
    )
    flags = ["vegetables", "fruits", "meat", "seafood", "mushrooms", "dairy", "grains", "nuts"]
    return orders.join(lines, "item_id", "left").na.fill(0, flags)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as items; label and the signs of two dimensions are their facets."""
    return text_table(spark, sf_dir, "embeddings", "vec_id").select(
        F.col("vec_id").alias("item_id"),
        "embedding",
        "label",
        (F.col("embedding")[0] > 0).cast("int").alias("first_sign"),
        F.when(F.col("embedding")[1] > 0, "up").otherwise("down").alias("second_sign"),
    )


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding asks for its neighbours."""
    return vectors(spark, sf_dir).withColumnRenamed("item_id", "query_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items: the text is what is done, the language and source the second field."""
    return text_table(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("item_id"),
        F.col("text").alias("directions"),
        F.concat_ws(" ", "lang", "source").alias("ingr"),
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("directions"), F.lit("en src1").alias("ingredients")
    )


def part_categories() -> F.Column:
    """A category text such as ``ECONOMY Recipes, red widget and Brand#17``."""
    return F.concat("p_type", F.lit(" Recipes,  "), "p_name", F.lit(" and "), "p_brand")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw items; names stand for dishes, sizes for cooking times."""
    dish = (
        F.when(F.contains("p_name", F.lit("gear")), "Main Dishes")
        .when(F.contains("p_name", F.lit("bolt")), "Healthy Soup Recipes")
        .when(F.contains("p_name", F.lit("ring")), "Vegan and Apple Pies Dessert")
        .when(F.contains("p_name", F.lit("rod")), "Dinner Salad")
        .otherwise("Cookies")
    )
    method = (
        F.when(F.contains("p_name", F.lit("hot")), "Preheat oven and bake, then grill")
        .when(F.contains("p_name", F.lit("cold")), "Chill in the freezer")
        .otherwise("Fry in a skillet")
    )
    lines = F.concat_ws(
        ",  ",
        F.lit("salt"),
        F.when(F.col("p_size") > 25, F.lit("2 cups flour")),
        F.when(F.contains("p_name", F.lit("red")), F.lit("1 tomato")),
        F.when(F.contains("p_name", F.lit("blue")), F.lit("fish fillet")),
        F.concat(F.lit("apple "), "p_brand"),
    )
    return text_table(spark, sf_dir, "part", "p_partkey").select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.initcap("p_type"), F.lit(" Recipes, "), dish).alias("categories"),
        F.col("p_retailprice").alias("calories"),
        F.col("p_size").cast("double").alias("fat"),
        F.col("p_size").cast("double").alias("carbs"),
        F.col("p_size").cast("double").alias("protein"),
        size_as_time().alias("total_time"),
        method.alias("directions"),
        lines.alias("ingr"),
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
    )


def size_as_time() -> F.Column:
    """Every part size as a duration; sizes below 10 lack the hours and cannot be read."""
    hours = F.floor(F.col("p_size") / 10).cast("string")
    minutes = (F.col("p_size") + 5).cast("string")
    return F.when(F.col("p_size") < 10, F.concat(minutes, F.lit(" mins"))).otherwise(
        F.concat(hours, F.when(hours == "1", " hr ").otherwise(" hrs "), minutes, F.lit(" mins"))
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as items: the id numbers them by conversation and turn."""
    return text_table(spark, sf_dir, "conversations", "conv_id").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
        F.col("text").alias("directions"),
        F.col("role").alias("ingr"),
        F.concat_ws("/", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("url"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden pairs: for each user turn, the next turn of its conversation."""
    rows = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    here = F.col("conv_id") * 1000 + F.col("turn")
    return rows.select(here.alias("query_id"), (here + 1).alias("relevant_id"))

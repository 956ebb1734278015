"""Readers and writers: CSV import and export, Parquet tables, the golden JSON."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.shared import stored
from kindred.sources import schemas


@dataclass(frozen=True)
class Catalogue:
    """Where the tables of one corpus lie, all below one root."""

    root: str

    @property
    def items_raw(self) -> str:
        return f"{self.root}/items_raw"

    @property
    def facets(self) -> str:
        return f"{self.root}/facets"

    @property
    def facets_encoded(self) -> str:
        return f"{self.root}/facets_encoded"

    @property
    def label_dictionary(self) -> str:
        return f"{self.root}/label_dictionary"

    @property
    def items_text(self) -> str:
        return f"{self.root}/items_text"

    def index(self, method: str) -> str:
        return f"{self.root}/index/{method}"


def read_csv(
    spark: SparkSession, path: str, headers: Mapping[str, str], key: str | None = None,
    labels_as_codes: bool = False,
) -> DataFrame:
    """Read a CSV with a header row into declared columns and an ``item_id``.

    ``key`` names an id column of the file. Without one, ids follow the line order of the
    files in path order, fixed once at ingest in a stored table. A file whose header differs
    from that of the others is an error, and so is a key that is no whole number.
    """
    head = csv_header(spark, path)
    named = ["item_id" if h == key else headers.get(h, h) for h in head]
    missing = [c for c in headers.values() if c not in named]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    types = {"item_id": "bigint", **schemas.types_of(labels_as_codes)}
    quoted = ["`" + h.replace("`", "``") + "`" for h in head]
    ddl = ", ".join(f"{q} {types.get(n, 'string')}" for q, n in zip(quoted, named, strict=True))
    rows = (
        spark.read.schema(ddl)
        .option("header", True).option("multiLine", True).option("escape", '"')
        # A nameless column has a name made up by the reader, which no header can equal.
        .option("enforceSchema", any(re.fullmatch(r"_c\d+", h) for h in head))
        .csv(path)
    )
    columns = {n: F.col(q).alias(n) for q, n in zip(quoted, named, strict=True)}
    wanted = [columns[n] for n in headers.values()]
    if not key:
        return number_lines(rows, wanted)
    bad = F.raise_error(F.lit(f"a key in {path} is no whole number")).cast("bigint")
    return rows.select(F.coalesce(columns["item_id"], bad).alias("item_id"), *wanted)


def unreadable_cells(
    spark: SparkSession, path: str, headers: Mapping[str, str], labels_as_codes: bool = False
) -> DataFrame:
    """(column, unreadable, n): cells of each typed column that hold something :func:`read_csv` turns into NULL."""
    types = {c: kind for c, kind in schemas.types_of(labels_as_codes).items() if c in headers.values() and kind != "string"}
    header_of = {c: h for h, c in headers.items()}
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)

    def bad(column: str) -> Column:
        cell = F.col("`" + header_of[column].replace("`", "``") + "`")
        return F.count_if(cell.isNotNull() & cell.try_cast(types[column]).isNull())

    counts = raw.agg(F.count("*").alias("n"), *[bad(c).alias(c) for c in types])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("unreadable"), F.col("n").alias("n")) for c in types])
    return counts.select(F.explode(each).alias("c")).select("c.*")


def number_lines(rows: DataFrame, columns: list[Column]) -> DataFrame:
    """Line numbers from 0 over all files; a multi-line CSV file is never split."""
    kept = stored(
        rows.select(
            *columns,
            F.col("_metadata.file_path").alias("_file"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "lines",
    )
    # One row per file, so the window is small; the table's size decides whether it is broadcast.
    files = kept.groupBy("_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1))
    files = files.select("_file", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at") - F.col("_first")
    return kept.join(stored(files, "files"), "_file").select(number.alias("item_id"), *kept.columns[:-2])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.option("inferSchema", False).csv(path).columns


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table as it lies; filters and column choice reach the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, headers: Mapping[str, str] | None = None,
              mode: str = "errorifexists") -> None:
    """CSV with a header; ``headers`` maps header -> column and fixes the order.

    Texts are written as they are: nothing is trimmed, and NULL differs from ``""``.
    """
    out = df if headers is None else df.select(*[F.col(c).alias(h) for h, c in headers.items()])
    writer = out.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def parse_golden(document: Column) -> Column:
    return F.from_json(document, "map<string,array<bigint>>")


def golden_rows(documents: DataFrame, column: str = "value") -> DataFrame:
    """(query_id, relevant_id), one row per listed id, repeats kept."""
    queries = documents.select(F.explode(parse_golden(F.col(column))).alias("q", "ids"))
    return queries.select(
        F.col("q").cast("bigint").alias("query_id"), F.explode("ids").alias("relevant_id")
    )


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """The golden set: one JSON object, query id -> list of relevant ids."""
    return golden_rows(spark.read.text(path, wholetext=True))

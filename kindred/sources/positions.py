"""Tables that belong together row by row: the n-th row of one to the n-th row of the other.

A row's position is its place in the files of its table, in the order of their paths. The reader knows the file and the
row's number in it, so only one number per file is summed up; no row is sorted or shuffled to be numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_positions(table: DataFrame) -> DataFrame:
    """``pos`` from 0 and the columns of a table that was read from Parquet and not changed since."""
    rows = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    # One row per file, so the window is small.
    before = F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1))
    offsets = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(offsets, "_file").select((F.col("_before") + F.col("_row")).alias("pos"), *table.columns)


def align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both tables side by side by position; different numbers of rows are an error. No name may stand in both."""
    counts = left.count(), right.count()  # from the footers of the files
    if counts[0] != counts[1]:
        raise ValueError(f"tables of {counts[0]} and {counts[1]} rows cannot be aligned")
    return with_positions(left).join(with_positions(right), "pos")

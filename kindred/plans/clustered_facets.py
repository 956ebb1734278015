"""A facet table in the order of a space-filling curve, so that limits on any column skip most of it.

Sorted by one column, a table can be skipped by limits on that column only. Here every range column is cut into 16
parts at its quantiles, and the bits of the parts are interleaved into one sort key: rows that lie near each other in
all columns lie near each other in the files, and every row group has a narrow range in every column. The reader needs
nothing special: the limits are pushed into the Parquet scan, which compares them with the statistics it has written.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.operators.range_grid import quantile_cuts, reached
from kindred.shared import scratch, stored

CURVE_COLUMNS = (*K.NUTRIENT_COLUMNS, "time_mins")
BITS = 4  # of each column
ROW_GROUP_BYTES = 16 * 1024 * 1024
ROWS_OF_A_TASK = 250_000


def curve_key(columns: Sequence[str], cuts: Sequence[Sequence[float]], bits: int = BITS) -> Column:
    """The bits of the part of every column, the highest bits first; NULL is in the lowest part."""
    parts = [F.coalesce(reached(F.col(c), values), F.lit(0)) for c, values in zip(columns, cuts, strict=True)]
    key = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for part in parts:
            key = key * 2 + F.shiftright(part, bit).bitwiseAND(F.lit(1))
    return key


def write_clustered(
    facets: DataFrame, path: str, columns: Sequence[str] = CURVE_COLUMNS, bits: int = BITS, row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write the table along the curve. Rows of one key can be spread over several files.

    A large table is cut into more parts than the session has for its shuffles, so that no task grows with it.
    """
    with scratch(facets.sparkSession):
        facets = stored(facets, "facets")  # read for the cuts, for their number and for the order
        key = curve_key(columns, quantile_cuts(facets, columns, 2**bits), bits)
        parts = [n] if (n := math.ceil(facets.count() / ROWS_OF_A_TASK)) > int(facets.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
        keyed = facets.withColumn("_key", key)
        ordered = keyed.repartitionByRange(*parts, "_key", "item_id").sortWithinPartitions("_key", "item_id").drop("_key")
        # The writer looks at its buffer every hundred rows, so small groups are kept small.
        ordered.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size.row.check.max", 100).parquet(path)

"""Labels of lines kept across runs: a line that was classified once is never sent to the model again.

The store is a folder of Parquet batches, one per run. A run reads the keys of what is there, drops known lines with
an anti join, classifies the others and appends them as a new batch. A key is the hash of a line in 128 bits, so the
lines themselves, which are longer, are neither joined nor kept. A batch is written under its own name by one
commit of the writer: a run that fails leaves no half of a batch behind, and its lines are classified by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import constants as K
from kindred.functions.models import INGREDIENT_CLASSIFIER
from kindred.operators.dictionary import join_counted
from kindred.plans.feature_build import ClassifierFactory, ingredient_labels

SCHEMA = "h1 bigint, h2 bigint, grp string, batch string"


def line_key() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]


@dataclass(frozen=True)
class LabelStore:
    spark: SparkSession
    path: str

    def labels(self) -> DataFrame:
        """(h1, h2, grp, batch) of every line classified so far; a line without a sure label has a NULL group."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def unknown(self, lines: DataFrame) -> DataFrame:
        """(line): distinct lines the store has no label for."""
        each = lines.groupBy("line").agg(F.lit(1).alias("_one")).where("line IS NOT NULL").select("line", *line_key())
        return each.join(self.labels().select("h1", "h2"), ["h1", "h2"], "left_anti").select("line")

    def add(
        self, lines: DataFrame, groups: Sequence[str] = K.INGREDIENT_GROUPS, factory: ClassifierFactory = INGREDIENT_CLASSIFIER,
        threshold: float = K.LABEL_CONFIDENCE, batch: str | None = None,
    ) -> str:
        """Classify what is new in a table of lines and append it; the name of the batch."""
        name = batch or uuid.uuid4().hex
        found = ingredient_labels(self.unknown(lines), groups, factory, threshold)
        found.select(*line_key(), "grp", F.lit(name).alias("batch")).write.mode("append").partitionBy("batch").parquet(self.path)
        return name

    def labelled(self, lines: DataFrame, spread_by: str) -> DataFrame:
        """``lines`` with their group and its batch, from the store alone; hot lines are looked up, not shuffled together."""
        keyed = lines.withColumn("_key", F.concat_ws(":", *[c.cast("string") for c in line_key()]))
        known = self.labels().select(F.concat_ws(":", "h1", "h2").alias("_key"), "grp", "batch")
        return join_counted(keyed, known, "_key", spread_by).drop("_key")

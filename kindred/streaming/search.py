"""Streams of items and queries.

The feature expressions hold no state, so ``plans.feature_build.label_features`` takes a
streaming table as it is. Ranking needs the whole corpus per query, so a stream of queries
is answered batch by batch against a fixed index.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from kindred.shared import scratch


def answer_stream(
    queries: DataFrame, search: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """A writer that appends ``search(batch)`` to the Parquet table at ``path``.

    Each micro-batch owns one ``batch_id`` folder and replaces it, so a batch that is run
    again after a failure leaves no double rows. Tables stored for a batch are removed with its end.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            search(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return queries.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)

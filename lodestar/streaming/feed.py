"""Micro-batches of source changes driven through the batch load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def increment_feed(
    changes: DataFrame,
    load: Callable[[DataFrame, int], None],
    checkpoint: str,
    first_run_id: int = 1,
) -> DataStreamWriter:
    """A stream writer that loads each micro-batch as one run.

    ``load`` gets the rows of the batch and its run id, which follows from the batch
    number: a batch that is repeated after a failure runs under the same id, starts
    from the same published state and replaces its own output. ``checkpoint`` is a
    shared folder.
    """

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        load(rows, first_run_id + batch_id)

    return changes.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)

"""Micro-batches: triggers, and several outputs per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.storagelevel import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval_s: int | None = None,
    name: str | None = None,
    keep: bool = True,
) -> StreamingQuery:
    """Start a query that gives every micro-batch and its number to ``handle``.

    With an interval the query runs until it is stopped; without one it takes what
    is there and ends. Positions are saved in ``checkpoint`` after the outputs are
    written, so a restart repeats at most the last batch, under the same number.
    A failing output fails the batch. ``keep`` holds the decoded batch while it is
    handled, for a ``handle`` that reads it several times.
    """

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    handler = kept if keep else handle
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval_s is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_s} seconds")
    return writer.start()


def query_id(batch: DataFrame) -> str:
    """The id of the query that handles ``batch``; it is kept in the query's checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Stop queries after the data they can already see is processed."""
    for query in queries:
        query.processAllAvailable()
        query.stop()

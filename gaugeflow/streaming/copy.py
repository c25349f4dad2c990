"""Copy messages of some topics into another, byte for byte."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def copied(messages: DataFrame, target: str) -> DataFrame:
    """The same values under a null key, addressed to ``target``."""
    return messages.select(
        F.lit(target).alias("topic"), F.lit(None).cast("string").alias("key"), "value"
    )


def pace_options(settings: Mapping[str, str]) -> dict[str, str]:
    """Kafka source options that bound a batch, if ``input.maxPerBatch`` is set."""
    most = settings.get("input.maxPerBatch")
    return {"maxOffsetsPerTrigger": most} if most else {}


def start_copy(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    until_stopped: bool = False,
    pause_s: float = 0,
) -> StreamingQuery:
    """Start the copy.

    With ``pause_s``, batches of a running copy start at least that far apart.
    """
    writer = (
        copied(messages, target)
        .writeStream.format(fmt)
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
    )
    if path:
        writer = writer.option("path", path).partitionBy("topic")
    if not until_stopped:
        writer = writer.trigger(availableNow=True)
    elif pause_s:
        writer = writer.trigger(processingTime=f"{pause_s} seconds")
    return writer.start()

"""Sampled readings as messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.schema import READING_COLUMNS
from gaugeflow.sinks.changes import ONLY
from gaugeflow.sinks.spread import spread

#: The topic of messages whose monitoring name has none.
UNROUTED = "UNROUTED"


def message_rows(
    df: DataFrame, topic: Column | str, avro_schema: str | None = None
) -> DataFrame:
    """``(topic, key, value)``: the ten reading fields under a null key.

    The value is JSON, or with a schema an Avro record, which needs Spark's Avro module.
    """
    name = F.lit(topic) if isinstance(topic, str) else topic
    reading = F.struct(*READING_COLUMNS)
    if avro_schema is None:
        value = F.to_json(reading).cast("binary")
    else:
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(reading, avro_schema)
    return df.select(
        name.alias("topic"), F.lit(None).cast("string").alias("key"), value.alias("value")
    )


def split_unrouted(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with a topic, and those that no topic wants."""
    return messages.where(F.col("topic").isNotNull()), messages.where(F.col("topic").isNull())


def write_messages(
    messages: DataFrame,
    root: str,
    batch_id: int,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    writer: str = ONLY,
    unrouted: str = UNROUTED,
) -> None:
    """Send one batch: to Kafka, or to files under ``messages/writer=W/batch_id=N/topic=T``.

    Messages that no topic wants go to the topic ``unrouted`` in the same write. File output
    replaces an earlier attempt of the batch; Kafka receives it again.
    """
    addressed = messages.withColumn("topic", F.coalesce("topic", F.lit(unrouted)))
    if fmt == "kafka":
        addressed.write.format("kafka").options(**(options or {})).save()
        return
    (
        spread(addressed, "topic", "value")
        .write.format(fmt)
        .mode("overwrite")
        .partitionBy("topic")
        .save(f"{root}/messages/writer={writer}/batch_id={batch_id}")
    )

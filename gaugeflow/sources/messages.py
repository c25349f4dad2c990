"""Readings that arrive as messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.schema import MESSAGE, READING, READING_COLUMNS

_CORRUPT = "_corrupt"
_READING_OR_CORRUPT = T.StructType([*READING.fields, T.StructField(_CORRUPT, T.StringType())])


def topic_stream(
    spark: SparkSession,
    topics: Sequence[str],
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    max_per_batch: int | None = None,
) -> DataFrame:
    """One stream of messages from several topics.

    ``kafka`` takes broker settings in ``options`` and needs Spark's Kafka module;
    a file format takes a ``path`` whose folders are named ``topic=...``.
    ``max_per_batch`` bounds a batch, in offsets or files, when there is a backlog.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if max_per_batch is not None:
        limit = "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(limit, max_per_batch)
    if fmt == "kafka":
        return reader.option("subscribe", ",".join(topics)).load()
    return reader.schema(MESSAGE).load(path).where(F.col("topic").isin(list(topics)))


def message_values(messages: DataFrame) -> DataFrame:
    """The values alone, without key and position."""
    return messages.select("value")


def _position() -> Column:
    """Arrival order inside a partition; distinguishes readings of equal times."""
    return F.struct("offset", "partition", "topic").alias("seq")


def _complete(field: T.StructField) -> Column:
    """A field of the record ``r``; a reading without it is an error."""
    message = F.lit(f"reading without {field.name}")
    value = F.col(f"r.{field.name}").cast(field.dataType)
    return F.coalesce(value, F.raise_error(message)).alias(field.name)


def _readings(messages: DataFrame, record: Column) -> DataFrame:
    """Filters on reading fields do not move below a generator; without it each of them would decode
    the record once more."""
    decoded = messages.select(_position(), F.explode(F.array(record)).alias("r"))
    return decoded.select(*[_complete(f) for f in READING.fields], "seq")


def decode_json(messages: DataFrame) -> DataFrame:
    """One reading per message; a message that is no whole reading stops the job."""
    value = F.col("value").cast("string")
    return _readings(messages, F.from_json(value, READING, {"mode": "FAILFAST"}))


def decode_json_lenient(messages: DataFrame) -> DataFrame:
    """As :func:`decode_json`, with ``broken`` holding the text of a message that
    cannot be read or lacks a field."""
    value = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.select(
        F.from_json(value, _READING_OR_CORRUPT, options).alias("r"),
        _position(),
        value.alias("_text"),
    )
    missing = F.lit(False)
    for name in READING_COLUMNS:
        missing = missing | F.col(f"r.{name}").isNull()
    broken = F.when(F.col(f"r.{_CORRUPT}").isNotNull() | missing, F.col("_text"))
    return parsed.select(
        *[F.col(f"r.{c}").alias(c) for c in READING_COLUMNS], "seq", broken.alias("broken")
    )


def decode_avro(messages: DataFrame, avro_schema: str) -> DataFrame:
    """Readings from Avro records of the given schema; needs Spark's Avro module."""
    from pyspark.sql.avro.functions import from_avro

    return _readings(messages, from_avro("value", avro_schema, {"mode": "FAILFAST"}))

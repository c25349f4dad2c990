"""Exact sampling by event time in Spark's own state: one row per sensor and bucket.

For samplers that are one plain aggregation. Spark combines rows before the shuffle, emits a
bucket once the watermark has passed it, and drops readings that are later than the allowed
delay. Jobs keep partial states in files instead (:mod:`gaugeflow.streaming.partials`): those
know the last pair of a bucket too, and set late readings aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.keys import time_bucket
from gaugeflow.operators.sampling import (
    channel_aggregates,
    channel_list,
    channel_values,
    exploded_channels,
    head_aggregates,
    head_values,
    ranked_columns,
)
from gaugeflow.schema import SENSOR_KEY

KEYS = ["window", *SENSOR_KEY]


def _windowed(df: DataFrame, bucket_ms: int, delay_ms: int) -> DataFrame:
    window = F.window("event_ts", f"{bucket_ms} milliseconds").alias("window")
    watched = df.withColumn("event_ts", F.timestamp_millis("time")).withWatermark(
        "event_ts", f"{delay_ms} milliseconds"
    )
    return watched.withColumn("window", window).drop("event_ts")


def _by_level_columns(stream: DataFrame) -> list[str]:
    others = [c for c in ranked_columns(stream, SENSOR_KEY) if c not in ("level", "values")]
    return ["level", *others]


def _by_level(stream: DataFrame) -> Column:
    return F.struct(*_by_level_columns(stream))


def _with_bucket(grouped: DataFrame, bucket_ms: int, columns: list[str]) -> DataFrame:
    bucket = time_bucket(F.unix_millis("window.start"), bucket_ms).alias("bucket")
    source = [F.col(c) if c in (*SENSOR_KEY, "values") else F.col(f"row.{c}") for c in columns]
    return grouped.select(*source, bucket)


def exact_earliest(stream: DataFrame, bucket_ms: int, delay_ms: int) -> DataFrame:
    """The earliest reading of each closed bucket."""
    ranked = F.struct(*ranked_columns(stream, SENSOR_KEY))
    grouped = _windowed(stream, bucket_ms, delay_ms).groupBy(*KEYS).agg(F.min(ranked).alias("row"))
    grouped = grouped.withColumn("values", F.col("row.values"))
    return _with_bucket(grouped, bucket_ms, stream.columns)


def exact_head_stats(
    stream: DataFrame, bucket_ms: int, delay_ms: int, on_empty: str = "error"
) -> DataFrame:
    """First-channel statistics of each closed bucket, on the latest reading of the
    highest alarm level."""
    picked = F.max(_by_level(stream)).alias("row")
    windowed = _windowed(stream, bucket_ms, delay_ms)
    grouped = windowed.groupBy(*KEYS).agg(picked, *head_aggregates())
    grouped = grouped.withColumn("values", head_values(on_empty))
    return _with_bucket(grouped, bucket_ms, stream.columns)


def exact_channel_stats(
    stream: DataFrame, bucket_ms: int, delay_ms: int, on_ragged: str = "error"
) -> DataFrame:
    """Statistics of all channels of each closed bucket, on the latest reading of the
    highest alarm level.

    Two aggregations in a row: per channel, then per bucket. The reading travels with
    its first channel alone.
    """
    row = F.struct(*_by_level_columns(stream), F.size("values").alias("width"))
    windowed = _windowed(stream, bucket_ms, delay_ms)
    exploded = exploded_channels(windowed, KEYS, row.alias("row"))
    candidate = F.when(F.coalesce("channel", F.lit(0)) == 0, F.col("row"))
    channels = exploded.groupBy(*KEYS, "channel").agg(
        F.max(candidate).alias("row"), *channel_aggregates()
    )
    grouped = channels.groupBy(*KEYS).agg(F.max("row").alias("row"), *channel_list())
    grouped = grouped.withColumn("values", channel_values(F.col("row.width"), on_ragged))
    return _with_bucket(grouped, bucket_ms, stream.columns)

"""Exact buckets across micro-batches from partial states in files.

Every batch leaves the sampling state of its readings in ``partial/bucket_day=D/batch_id=N``, D the day
on which the bucket starts. The greatest event time that a stream has seen is kept by batch in
``seen``; less the allowed delay it is the stream's watermark. When the watermark has passed buckets, the
states of their days are merged and each bucket is given out once. Readings of buckets that were given
out before their batch are late: they change nothing and are kept by themselves.

A repeated batch starts from what the batch before it had seen. It replaces its own states and gives out
the same buckets again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.keys import time_bucket
from gaugeflow.operators.sampling import MERGEABLE, bucketed
from gaugeflow.schema import DAY_MS
from gaugeflow.sinks.folders import children, make_folder, matching, remove
from gaugeflow.sinks.spread import spread

#: Marks of so many last batches stay.
KEPT_MARKS = 10


@dataclass(frozen=True)
class Partials:
    """The states of one sampled output, kept below ``root``."""

    root: str
    sampler: str
    bucket_ms: int
    options: Mapping[str, str]

    def write(self, readings: DataFrame, batch_id: int) -> T.StructType:
        """Write the state of one batch, replacing an earlier attempt; returns what states look like."""
        state = MERGEABLE[self.sampler].state(readings, self.bucket_ms, self.options)
        start = F.col("bucket") * F.lit(self.bucket_ms).cast("bigint")
        dated = state.withColumn("bucket_day", F.date_from_unix_date(time_bucket(start, DAY_MS).cast("int")))
        (
            spread(dated, "bucket_day", "sensor")
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket_day", "batch_id")
            .parquet(f"{self.root}/partial")
        )
        return state.schema

    def states(
        self, spark: SparkSession, schema: T.StructType, from_ms: int | None = None, until_ms: int | None = None
    ) -> DataFrame:
        """States of the buckets from the one time to the other, both at a bucket's start.

        Only the folders of days in question are listed.
        """
        first = None if from_ms is None else _day(from_ms)
        last = None if until_ms is None else _day(until_ms - self.bucket_ms)
        folders = [
            path
            for day, path in children(spark, f"{self.root}/partial")
            if (first is None or day >= f"{first:%Y-%m-%d}") and (last is None or day <= f"{last:%Y-%m-%d}")
        ]
        whole = schema.add("bucket_day", T.DateType()).add("batch_id", T.LongType())
        if not folders:
            return spark.createDataFrame([], whole).select(*schema.names)
        rows = spark.read.schema(whole).option("basePath", f"{self.root}/partial").parquet(*folders)
        if first is not None:
            rows = rows.where((F.col("bucket_day") >= first) & (F.col("bucket") >= from_ms // self.bucket_ms))
        if last is not None:
            rows = rows.where((F.col("bucket_day") <= last) & (F.col("bucket") < until_ms // self.bucket_ms))
        return rows.drop("bucket_day", "batch_id")

    def sampled(
        self, spark: SparkSession, schema: T.StructType, from_ms: int | None = None, until_ms: int | None = None
    ) -> DataFrame:
        """One row per group of these buckets, over all batches."""
        states = self.states(spark, schema, from_ms, until_ms)
        return MERGEABLE[self.sampler].sampled(states, self.options)

    def closed(self, seen_ms: int | None, delay_ms: int) -> int | None:
        """The start of the first open bucket at a watermark of ``seen_ms - delay_ms``."""
        return None if seen_ms is None else (seen_ms - delay_ms) // self.bucket_ms * self.bucket_ms

    def split_late(self, readings: DataFrame, closed_ms: int | None) -> tuple[DataFrame, DataFrame]:
        """Readings of open buckets, and those whose bucket has been given out."""
        rows = bucketed(readings, self.bucket_ms)
        if closed_ms is None:
            return readings, readings.where("false")
        is_late = F.col("bucket") < closed_ms // self.bucket_ms
        return rows.where(~is_late).drop("bucket"), rows.where(is_late).drop("bucket")

    def drop_spent(self, spark: SparkSession, closed_ms: int | None) -> None:
        """Remove the states of days whose buckets have all been given out."""
        if closed_ms is None:
            return
        first_open = f"{_day(closed_ms):%Y-%m-%d}"
        for day, path in children(spark, f"{self.root}/partial"):
            if day < first_open:
                remove(spark, path)


def _day(ms: int) -> date:
    return datetime.fromtimestamp(ms // 1000, UTC).date()


def last_seen(spark: SparkSession, root: str, before_batch: int) -> int | None:
    """The greatest event time up to the batch before ``before_batch``."""
    marks = [mark for batch, mark in _marks(spark, root) if batch < before_batch]
    return max(marks, default=None)


def mark_seen(spark: SparkSession, root: str, batch_id: int, seen_ms: int) -> None:
    """Keep how far the batch has seen. The name of a folder holds it, so it is there whole or not at all."""
    make_folder(spark, f"{root}/seen/batch={batch_id}_{seen_ms}")
    for batch, mark in _marks(spark, root):
        if batch <= batch_id - KEPT_MARKS:
            remove(spark, f"{root}/seen/batch={batch}_{mark}")


def _marks(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    return [
        (int(batch), int(mark))
        for name, _ in children(spark, f"{root}/seen")
        for batch, mark in [name.split("_")]
    ]


def late_readings(spark: SparkSession, root: str) -> DataFrame:
    """All readings that came after their bucket had been given out, with ``writer``, number of the
    ``output`` in its job, and ``batch_id``."""
    if not matching(spark, f"{root}/late"):
        raise FileNotFoundError(f"no late readings in {root}")
    return spark.read.parquet(f"{root}/late")

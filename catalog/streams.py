"""Streaming queries, run over all messages until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    ARRIVED_SQL,
    DAY,
    GROUP_SQL,
    TOPICS,
    batched_topic_stream,
    message_folder,
    query,
)
from catalog.sampling import (
    CHANNELS_SQL,
    GROUP,
    HEAD_SQL,
    MAX_LEVEL_SQL,
    bucketed_sql,
    last_pair_sql,
    per_channel,
)
from gaugeflow.schema import MESSAGE
from gaugeflow.session import shared_folder
from gaugeflow.sources.messages import decode_json, topic_stream
from gaugeflow.streaming.batches import run_batches
from gaugeflow.streaming.copy import start_copy
from gaugeflow.streaming.event_time import (
    exact_channel_stats,
    exact_earliest,
    exact_head_stats,
)
from gaugeflow.streaming.partials import Partials

BUCKET = 5 * DAY
CLOSED_SQL = f"(bucket + 1) * {BUCKET} <= (SELECT max(time) - {DAY} FROM readings)"


def _stream(spark, sf_dir):
    """Decoded readings; ``seq`` is the offset."""
    messages = topic_stream(spark, TOPICS, "parquet", path=message_folder(spark, sf_dir))
    return decode_json(messages).withColumn("seq", F.col("seq.offset"))


def _drained(spark, rows, label):
    """Run an append query to its end and read what it wrote."""
    out = shared_folder(spark, label)
    (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{out}/positions")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


def _three(df):
    names = ("v_max", "v_min", "v_mean")
    parts = [F.col("values")[i].cast("double").alias(n) for i, n in enumerate(names)]
    return df.select(*GROUP, "seq", "level", *parts)


@query(
    "event_time_exact",
    f", {bucketed_sql(BUCKET)} SELECT {GROUP_SQL}, seq, time FROM b WHERE {CLOSED_SQL}"
    f" QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1",
)
def event_time_exact(spark, sf_dir):
    """Earliest reading of each bucket that the watermark closed."""
    rows = exact_earliest(_stream(spark, sf_dir), BUCKET, delay_ms=DAY)
    return _drained(spark, rows, "exact").select(*GROUP, "seq", "time")


@query(
    "event_time_exact_stats",
    f", {MAX_LEVEL_SQL.replace(str(DAY), str(BUCKET))}, {HEAD_SQL} SELECT {GROUP_SQL}, seq, level,"
    f" v_max, v_min, v_mean FROM rep JOIN head USING ({GROUP_SQL}) WHERE {CLOSED_SQL}",
)
def event_time_exact_stats(spark, sf_dir):
    rows = exact_head_stats(_stream(spark, sf_dir), BUCKET, delay_ms=DAY)
    return _three(_drained(spark, rows, "exact-stats"))


@query(
    "event_time_exact_channels",
    f", {MAX_LEVEL_SQL.replace(str(DAY), str(BUCKET))}, {CHANNELS_SQL} SELECT {GROUP_SQL}, seq, level,"
    f" channel, v_max, v_min, v_mean FROM rep JOIN ch USING ({GROUP_SQL}) WHERE {CLOSED_SQL}",
)
def event_time_exact_channels(spark, sf_dir):
    rows = exact_channel_stats(_stream(spark, sf_dir), BUCKET, delay_ms=DAY)
    return per_channel(_drained(spark, rows, "exact-channels"), [*GROUP, "seq", "level"])


@query(
    "event_time_merged",
    f", {last_pair_sql(BUCKET)}, {HEAD_SQL} SELECT {GROUP_SQL}, seq, level, v_max, v_min, v_mean"
    f" FROM rep JOIN head USING ({GROUP_SQL})",
)
def event_time_merged(spark, sf_dir):
    """Last pair over all batches, from the partial states of a stream."""
    root = shared_folder(spark, "merged")
    partials = Partials(root, "head_stats", BUCKET, {})
    schemas = []

    def handle(batch, batch_id):
        schemas.append(partials.write(batch, batch_id))

    run_batches(_stream(spark, sf_dir), handle, f"{root}/positions").awaitTermination()
    return _three(partials.sampled(spark, schemas[-1]))


@query(
    "topic_copy",
    "SELECT 'COPY' AS topic, TRUE AS no_key, value FROM messages",
)
def topic_copy(spark, sf_dir):
    out = shared_folder(spark, "copy")
    source = topic_stream(spark, TOPICS, "parquet", path=message_folder(spark, sf_dir))
    copy = start_copy(source, "COPY", f"{out}/positions", "parquet", path=f"{out}/rows")
    copy.awaitTermination()
    rows = spark.read.schema(MESSAGE).parquet(f"{out}/rows")
    value = F.col("value").cast("string").alias("value")
    return rows.select("topic", F.col("key").isNull().alias("no_key"), value)


@query(
    "copy_progress",
    f", {ARRIVED_SQL} SELECT batch::BIGINT AS batch_id, count(*) AS rows, count(DISTINCT monitoring) AS topics"
    " FROM arrived GROUP BY batch",
)
def copy_progress(spark, sf_dir):
    """Rows and topics of every batch of a copy, counted in the copied rows."""
    out = shared_folder(spark, "progress")
    source = batched_topic_stream(spark, TOPICS, sf_dir)

    def handle(batch, batch_id):
        copy = batch.withColumn("source", F.col("topic")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        copy.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    run_batches(source, handle, f"{out}/positions", keep=False).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count_distinct("source").alias("topics")
    )

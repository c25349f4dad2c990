"""Messages, saved positions and day tables."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalog.base import (
    ARRIVED_SQL,
    MESSAGE,
    TOPICS,
    VALUES_TEXT_SQL,
    batched_topic_stream,
    day_table,
    day_tables,
    message_folder,
    messages,
    query,
)
from gaugeflow.functions import values_text
from gaugeflow.schema import READING_COLUMNS
from gaugeflow.session import shared_folder
from gaugeflow.sources import messages as M
from gaugeflow.sources import tables
from gaugeflow.streaming.batches import run_batches

READING_SQL = (
    'location, terminal, sensor, rtime, "sensorType", "dataType", monitoring, time, level,'
    f' {VALUES_TEXT_SQL} AS "values"'
)
DT_SQL = "strftime(make_timestamp_ms(time), '%Y%m%d')"


def _shown(df, *more):
    return df.select(*READING_COLUMNS, *more).withColumn("values", values_text("values"))


@query(
    "topic_stream",
    'SELECT topic, "offset", value FROM messages',
)
def topic_stream(spark, sf_dir):
    """All topics as one stream, drained into a table."""
    out = shared_folder(spark, "stream")
    stream = M.topic_stream(spark, TOPICS, "parquet", path=message_folder(spark, sf_dir))
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/positions")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
        .awaitTermination()
    )
    rows = spark.read.schema(MESSAGE).parquet(f"{out}/rows")
    return rows.select("topic", "offset", F.col("value").cast("string").alias("value"))


@query("union_topics", 'SELECT "offset" AS seq, topic FROM messages')
def union_topics(spark, sf_dir):
    """Six topics as one stream of micro-batches, one file each."""
    out = shared_folder(spark, "union")
    path = message_folder(spark, sf_dir)
    stream = M.topic_stream(spark, TOPICS, "parquet", path=path, max_per_batch=2)
    (
        stream.select(F.col("offset").alias("seq"), "topic")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/positions")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
        .awaitTermination()
    )
    return spark.read.schema("seq bigint, topic string").parquet(f"{out}/rows")


RESUMED_SQL = """resumed AS (SELECT topic, "partition", "offset" FROM messages JOIN arrived ON seq = "offset"
    WHERE batch >= 2)"""


def _resumed(spark, sf_dir):
    """What a stream reads after it failed in its third batch and was started again.

    Its positions are those that the checkpoint kept of the batches before.
    """
    out = shared_folder(spark, "resumed")
    fails = [2]

    def handle(batch, batch_id):
        if batch_id in fails:
            fails.remove(batch_id)
            raise RuntimeError("the third batch fails once")
        rows = batch.select("topic", "partition", "offset")
        rows.write.mode("overwrite").parquet(f"{out}/rows/run={2 - len(fails)}/batch={batch_id}")

    def run():
        stream = batched_topic_stream(spark, TOPICS, sf_dir)
        run_batches(stream, handle, f"{out}/positions", keep=False).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        run()
    schema = 'topic string, `partition` int, `offset` bigint'
    return spark.read.schema(schema).parquet(f"{out}/rows/run=2/*")


@query(
    "start_positions",
    f', {ARRIVED_SQL}, {RESUMED_SQL} SELECT topic, "partition", min("offset") AS start FROM resumed GROUP BY ALL',
)
def start_positions(spark, sf_dir):
    """The first position of every topic and partition after a restart."""
    return _resumed(spark, sf_dir).groupBy("topic", "partition").agg(F.min("offset").alias("start"))


@query("replay_from_offsets", f", {ARRIVED_SQL}, {RESUMED_SQL} SELECT * FROM resumed")
def replay_from_offsets(spark, sf_dir):
    """All messages after a restart: the batch that failed, and those behind it."""
    return _resumed(spark, sf_dir)


@query("message_values", "SELECT value FROM messages")
def message_values(spark, sf_dir):
    values = M.message_values(messages(spark, sf_dir))
    return values.select(F.col("value").cast("string").alias("value"))


@query("decode_json", f"SELECT {READING_SQL}, seq AS offset FROM readings")
def decode_json(spark, sf_dir):
    rows = M.decode_json(messages(spark, sf_dir))
    return _shown(rows, F.col("seq.offset").alias("offset"))


@query("decode_json_lenient", f"SELECT {READING_SQL}, FALSE AS is_broken FROM readings")
def decode_json_lenient(spark, sf_dir):
    rows = M.decode_json_lenient(messages(spark, sf_dir))
    return _shown(rows, F.col("broken").isNotNull().alias("is_broken"))


@query(
    "project_reading",
    'SELECT location, terminal, sensor, rtime, "sensorType", "dataType", monitoring, time, level,'
    ' CAST("values"[1] AS DOUBLE) AS first FROM readings',
)
def project_reading(spark, sf_dir):
    rows = M.decode_json(messages(spark, sf_dir)).drop("seq")
    return rows.withColumn("first", F.col("values")[0].cast("double")).drop("values")


@query("positional_projection", f"SELECT {READING_SQL} FROM readings")
def positional_projection(spark, sf_dir):
    parts = [t.select(*tables.positional_reading(t)) for t in day_tables(spark, sf_dir).values()]
    return _shown(parts[0].unionByName(parts[1]))


@query(
    "day_partition_scan",
    f"SELECT {READING_SQL}, {DT_SQL} AS dt FROM readings"
    f" WHERE \"sensorType\" = 'FLOW' AND {DT_SQL} = '20240115'",
)
def day_partition_scan(spark, sf_dir):
    return _shown(tables.one_day(day_table(spark, sf_dir, odd=True), "20240115"), "dt")


@query(
    "day_range_scan",
    f"SELECT {READING_SQL}, {DT_SQL} AS dt FROM readings WHERE {DT_SQL} BETWEEN '20240105' AND '20240126'",
)
def day_range_scan(spark, sf_dir):
    """Days in the middle of the month, of both tables."""
    parts = [tables.day_range(t, "20240105", "20240126") for t in day_tables(spark, sf_dir).values()]
    return _shown(parts[0].unionByName(parts[1]), "dt")


@query(
    "union_tables_days",
    f"SELECT {READING_SQL}, {DT_SQL} AS dt,"
    " CASE \"sensorType\" WHEN 'FLOW' THEN 'flow' ELSE 'pressure' END AS source_table"
    " FROM readings",
)
def union_tables_days(spark, sf_dir):
    rows = tables.tables_and_days(day_tables(spark, sf_dir), "20240101", "20240131")
    return _shown(rows, "dt", "source_table")

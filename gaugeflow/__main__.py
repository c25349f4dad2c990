"""``python -m gaugeflow JOB PROPERTIES``: run a job as its properties file says.

JOB is a streaming job, ``bridge_backfill``, ``gaswater_backfill`` or ``topic_copy``.
"""

from __future__ import annotations

import logging
import signal
import sys
import threading
from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.functions.keys import days_between
from gaugeflow.plans.backfill import bridge_backfill, earliest_backfill, run_backfill
from gaugeflow.plans.jobs import COPY_INPUT, JOBS, JobSpec
from gaugeflow.plans.runner import start_exact_job, start_job
from gaugeflow.plans.settings import (
    broker_options,
    configured,
    consumer_options,
    load_properties,
    required,
)
from gaugeflow.schema import SECOND_MS
from gaugeflow.session import build_session
from gaugeflow.sources.messages import decode_avro, decode_json, topic_stream
from gaugeflow.sources.tables import day_bounds, named_tables
from gaugeflow.streaming.batches import drain
from gaugeflow.streaming.copy import pace_options, start_copy

Settings = Mapping[str, str]

#: How often a waiting job looks whether it was told to stop.
WAIT_S = 2


def _messages(spark: SparkSession, topics: tuple[str, ...], settings: Settings) -> DataFrame:
    fmt = settings.get("input.format", "kafka")
    if fmt == "kafka":
        required(settings, "kafka.broker.list")
    options = consumer_options(settings) if fmt == "kafka" else {}
    limit = settings.get("input.maxPerBatch")
    return topic_stream(
        spark, topics, fmt, options, settings.get("input.path"), int(limit) if limit else None
    )


def _avro_schema(settings: Settings) -> str:
    required(settings, "input.avroSchema")
    with open(settings["input.avroSchema"], encoding="utf-8") as schema:
        return schema.read()


def _decoded(messages: DataFrame, settings: Settings) -> DataFrame:
    if settings.get("input.encoding", "avro") == "json":
        return decode_json(messages)
    return decode_avro(messages, _avro_schema(settings))


def _until_stopped(query: StreamingQuery) -> None:
    """Wait for the end of a query; on SIGTERM take what has arrived, then stop."""
    stop = threading.Event()
    signal.signal(signal.SIGTERM, lambda *_: stop.set())
    while not stop.is_set():
        if query.awaitTermination(WAIT_S):
            return
    drain([query])


def run_stream(spark: SparkSession, spec: JobSpec, settings: Settings) -> None:
    required(settings, "output.path", "spark.checkpointPath")
    spec = configured(spec, settings)
    readings = _decoded(_messages(spark, spec.topics, settings), settings)
    message_format = settings.get("output.format", "kafka")
    to_kafka = message_format == "kafka" and any(o.topic for o in spec.outputs)
    if to_kafka:
        required(settings, "kafka.broker.list")
    if settings.get("input.encoding", "avro") == "avro":
        spec = replace(spec, avro_schema=_avro_schema(settings))
    start = start_job
    if settings.get("sample.exact") == "true":
        required(settings, "sample.delayMs")
        start = partial(start_exact_job, delay_ms=int(settings["sample.delayMs"]))
    query = start(
        spec,
        readings,
        settings["output.path"],
        settings["spark.checkpointPath"],
        until_stopped=settings.get("once") != "true",
        message_format=message_format,
        message_options=broker_options(settings) if to_kafka else None,
        cells=settings.get("output.cells") == "true",
    )
    _until_stopped(query)


def run_copy(spark: SparkSession, settings: Settings) -> None:
    required(settings, "sendTopic", "spark.checkpointPath")
    topics = settings.get("kafka.topic")
    names = topics.split(",") if topics else COPY_INPUT
    fmt = settings.get("input.format", "kafka")
    kafka = fmt == "kafka"
    if kafka:
        required(settings, "kafka.broker.list")
    options = {**consumer_options(settings), **pace_options(settings)} if kafka else {}
    limit = settings.get("input.maxPerBatch") if not kafka else None
    query = start_copy(
        topic_stream(spark, names, fmt, options, settings.get("input.path"), int(limit) if limit else None),
        settings["sendTopic"],
        settings["spark.checkpointPath"],
        fmt,
        broker_options(settings) if kafka else {},
        settings.get("output.path"),
        until_stopped=settings.get("once") != "true",
        pause_s=float(settings.get("copy.pauseSeconds", "0")),
    )
    _until_stopped(query)


def _days(settings: Settings) -> tuple[str, str]:
    zone = settings.get("timezone", "UTC")
    return day_bounds(settings.get("startDay"), settings.get("endDay"), zone)


def run_bridge_backfill(spark: SparkSession, settings: Settings) -> None:
    """Writes only if ``isTest`` is set to false; otherwise shows what would be read."""
    required(settings, "hiveTable", "output.path")
    names = settings["hiveTable"].split(",")
    days = _days(settings)
    if settings.get("isTest", "true").lower() != "false":
        first, last = (datetime.strptime(day, "%Y%m%d").date() for day in days)
        for day in days_between(first, last):
            print("\n".join(f"{name} dt={day}" for name in names))
        return
    rows = bridge_backfill(named_tables(spark, names), *days)
    run_backfill(rows, settings["output.path"])


def run_earliest_backfill(spark: SparkSession, settings: Settings) -> None:
    required(settings, "hiveTable", "hbaseTable", "output.path")
    tables = named_tables(spark, settings["hiveTable"].split(","))
    days = _days(settings)
    bucket_ms = int(settings.get("sampleTime", SECOND_MS))
    rows = earliest_backfill(tables, *days, settings["hbaseTable"], bucket_ms)
    run_backfill(rows, settings["output.path"])


OTHERS = {
    "topic_copy": run_copy,
    "bridge_backfill": run_bridge_backfill,
    "gaswater_backfill": run_earliest_backfill,
}


def main(arguments: list[str]) -> None:
    if len(arguments) != 2 or arguments[0] not in {*JOBS, *OTHERS}:
        raise SystemExit(f"usage: python -m gaugeflow JOB PROPERTIES\njobs: {', '.join([*JOBS, *OTHERS])}")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    job, path = arguments
    settings = load_properties(path)
    spark = build_session(
        job, settings.get("timezone", "UTC"), hive=settings.get("hive.support") == "true"
    )
    if job in JOBS:
        run_stream(spark, JOBS[job], settings)
    else:
        OTHERS[job](spark, settings)


if __name__ == "__main__":
    main(sys.argv[1:])

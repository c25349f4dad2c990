"""Run a job over a stream of messages, or over readings that are already there."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.storagelevel import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.operators.filters import FILTERS
from gaugeflow.operators.lookup import with_topic
from gaugeflow.operators.routing import counts_by_table, stored_rows
from gaugeflow.operators.sampling import SAMPLERS
from gaugeflow.plans.jobs import BY_MONITORING, JobSpec, Output
from gaugeflow.sinks.cells import write_cells
from gaugeflow.sinks.changes import ONLY, write_changes
from gaugeflow.sinks.messages import message_rows, write_messages
from gaugeflow.streaming.batches import query_id, run_batches
from gaugeflow.streaming.partials import Partials, last_seen, mark_seen

logger = logging.getLogger(__name__)


def sampled(spec: JobSpec, output: Output, readings: DataFrame) -> DataFrame:
    """The readings that one output is about."""
    rows = FILTERS[output.rows](readings)
    return SAMPLERS[output.sampler](rows, spec.bucket_ms, **output.options)


def keyed(spec: JobSpec, output: Output, rows: DataFrame) -> DataFrame:
    table = output.table if isinstance(output.table, str) else output.table()
    floor_ms = spec.bucket_ms if output.floored else None
    return stored_rows(rows, table, floor_ms, output.columns)


def addressed(spec: JobSpec, output: Output, rows: DataFrame) -> DataFrame:
    if output.topic == BY_MONITORING:
        rows = with_topic(rows, spec.topic_by_monitoring)
        return message_rows(rows, F.col("topic"), spec.avro_schema)
    return message_rows(rows, output.topic, spec.avro_schema)


#: How often a sampler reads its input.
SCANS = {"none": 1, "earliest": 1, "head_stats": 2, "channel_stats": 2, "conditional_stats": 2}

#: A batch that is read more often than this is decoded once and kept.
SCANS_WITHOUT_STORING = 1


def scans(spec: JobSpec) -> int:
    return sum(SCANS[o.sampler] for o in spec.outputs)


def job_rows(spec: JobSpec, readings: DataFrame) -> DataFrame:
    """All stored rows of a job for some readings, of all its tables."""
    parts = [keyed(spec, o, sampled(spec, o, readings)) for o in spec.outputs]
    return reduce(DataFrame.unionByName, parts)


def run_batch(
    spec: JobSpec,
    readings: DataFrame,
    root: str,
    batch_id: int,
    message_format: str = "parquet",
    message_options: Mapping[str, str] | None = None,
    writer: str = ONLY,
    cells: bool = False,
) -> dict[str, int]:
    """Write stored rows and messages of one batch of readings; returns the rows by table."""
    parts = [(o, sampled(spec, o, readings)) for o in spec.outputs]
    return write_outputs(spec, parts, root, batch_id, message_format, message_options, writer, cells)


def _observed(counted: Observation) -> dict[str, int]:
    """Observed sums by name. Spark drops an observation from a plan that it finds to be empty;
    reading it fails then, and nothing was counted."""
    try:
        return {name: n or 0 for name, n in counted.get.items()}
    except Py4JJavaError:
        return {}


def write_outputs(
    spec: JobSpec,
    parts: Sequence[tuple[Output, DataFrame]],
    root: str,
    batch_id: int,
    message_format: str = "parquet",
    message_options: Mapping[str, str] | None = None,
    writer: str = ONLY,
    cells: bool = False,
) -> dict[str, int]:
    """Write the sampled readings of all outputs.

    All tables are written by one job, so a batch is either there or not. Sampled
    rows that are also sent are kept for the second write, as are all rows that are
    also written as cells. The rows of each table are counted as they are written.
    """
    stored, messages, kept = [], [], []

    def keep(rows: DataFrame) -> DataFrame:
        kept.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    for output, rows in parts:
        if output.topic:
            rows = keep(rows)
            messages.append(addressed(spec, output, rows))
        stored.append(keyed(spec, output, rows))
    try:
        all_rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), stored)
        if cells:
            all_rows = keep(all_rows)
            write_cells(all_rows, root, batch_id, writer)
        counted = Observation()
        counts = counts_by_table([o.families for o, _ in parts])
        write_changes(all_rows.observe(counted, *counts), root, batch_id, writer)
        n_rows = _observed(counted)
        shown = ", ".join(f"{table} {n}" for table, n in sorted(n_rows.items()))
        logger.info("%s: batch %d, rows written: %s", spec.name, batch_id, shown)
        if messages:
            all_messages = reduce(DataFrame.unionByName, messages)
            write_messages(all_messages, root, batch_id, message_format, message_options, writer)
        return n_rows
    finally:
        for rows in kept:
            rows.unpersist()


def start_job(
    spec: JobSpec,
    readings: DataFrame,
    root: str,
    checkpoint: str,
    until_stopped: bool = False,
    message_format: str = "parquet",
    message_options: Mapping[str, str] | None = None,
    cells: bool = False,
) -> StreamingQuery:
    """Start a job on a stream of decoded readings.

    Buckets do not reach across batches: a later batch overwrites the row of a
    bucket that it touches again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        writer = query_id(batch)
        run_batch(spec, batch, root, batch_id, message_format, message_options, writer, cells)

    interval = spec.interval_s if until_stopped else None
    keep = scans(spec) > SCANS_WITHOUT_STORING
    return run_batches(readings, handle, checkpoint, interval, spec.name, keep)


def run_exact_batch(
    spec: JobSpec,
    readings: DataFrame,
    root: str,
    batch_id: int,
    delay_ms: int,
    message_format: str = "parquet",
    message_options: Mapping[str, str] | None = None,
    writer: str = ONLY,
    cells: bool = False,
) -> dict[str, int]:
    """As :func:`run_batch`, but a sampled bucket is written once, over all batches.

    That is when the stream's watermark, ``delay_ms`` behind the latest reading, has passed the
    bucket. Readings that come later are written below ``late``, one folder per output and batch.
    """
    spark = readings.sparkSession
    place = f"{root}/exact/{writer}"
    before = last_seen(spark, place, batch_id)
    newest = readings.agg(F.max("time")).first()[0]
    seen = max((t for t in (before, newest) if t is not None), default=None)
    parts = []
    for k, output in enumerate(spec.outputs):
        if output.sampler == "none":
            parts.append((output, sampled(spec, output, readings)))
            continue
        partials = Partials(f"{place}/{k}", output.sampler, spec.bucket_ms, output.options)
        done, until = partials.closed(before, delay_ms), partials.closed(seen, delay_ms)
        partials.drop_spent(spark, done)
        in_time, late = partials.split_late(FILTERS[output.rows](readings), done)
        schema = partials.write(in_time, batch_id)
        if done is not None:
            late.write.mode("overwrite").parquet(f"{root}/late/writer={writer}/output={k}/batch_id={batch_id}")
        if until is not None:
            parts.append((output, partials.sampled(spark, schema, done, until)))
    written = {}
    if parts:
        written = write_outputs(spec, parts, root, batch_id, message_format, message_options, writer, cells)
    if seen is not None:
        mark_seen(spark, place, batch_id, seen)
    return written


def start_exact_job(
    spec: JobSpec,
    readings: DataFrame,
    root: str,
    checkpoint: str,
    delay_ms: int,
    until_stopped: bool = False,
    message_format: str = "parquet",
    message_options: Mapping[str, str] | None = None,
    cells: bool = False,
) -> StreamingQuery:
    """Start a job whose buckets reach across batches (:func:`run_exact_batch`)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_exact_batch(
            spec, batch, root, batch_id, delay_ms, message_format, message_options, query_id(batch), cells
        )

    interval = spec.interval_s if until_stopped else None
    return run_batches(readings, handle, checkpoint, interval, f"{spec.name}_exact")

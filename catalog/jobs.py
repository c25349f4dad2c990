"""Every job from messages to what its store holds."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.base import (
    ARRIVED_SQL,
    DAY,
    GROUP_SQL,
    JSON_SQL,
    MESSAGE,
    TOPICS,
    batched_topic_stream,
    day_tables,
    message_folder,
    newest_sql,
    query,
    rowkey_sql,
    stored_sql,
)
from catalog.routing import DETAIL_TABLE_SQL, STORED, TOPIC_SQL
from catalog.sampling import bucketed_sql, last_pair_sql
from gaugeflow.plans.backfill import bridge_backfill, earliest_backfill, run_backfill
from gaugeflow.plans.jobs import JOBS
from gaugeflow.plans.runner import start_exact_job, start_job
from gaugeflow.schema import FLOW_COLUMNS, HOUR_MS, SECOND_MS, TEN_MINUTES_MS
from gaugeflow.session import shared_folder
from gaugeflow.sinks.changes import current
from gaugeflow.sources.messages import decode_json, topic_stream
from gaugeflow.streaming.partials import late_readings


def _run(spark, sf_dir, name):
    """Drain all topics through a job; returns the folder of its outputs."""
    spec = replace(JOBS[name], topics=tuple(TOPICS))
    root = shared_folder(spark, name)
    source = topic_stream(spark, spec.topics, "parquet", path=message_folder(spark, sf_dir))
    start_job(spec, decode_json(source), root, f"{root}/positions").awaitTermination()
    return root


def _stored(spark, root, columns=STORED):
    return current(spark, root).select(*columns)


# Hardly any bucket of these jobs holds two readings of a sensor in these tables, and all come in one
# batch. The queries further below use longer buckets and four batches.


def _newest(rows: str, table: str, floor_ms: int | None) -> str:
    """Stored rows of ``rows`` after the upsert."""
    inner = f"SELECT *, {table} AS tab, {rowkey_sql(floor_ms)} AS rk FROM {rows}"
    newest = newest_sql(f"({inner})")
    return stored_sql(table, floor_ms, f"({newest})")


def earliest_sql(bucket_ms: int) -> str:
    return (
        f"(WITH {bucketed_sql(bucket_ms)} SELECT * EXCLUDE (bucket) FROM b QUALIFY row_number()"
        f" OVER (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1)"
    )


def head_sql(bucket_ms: int) -> str:
    """Representative rows with ``values`` = max, min, mean of the first channel."""
    return f"""(WITH {last_pair_sql(bucket_ms, "\"dataType\" = 'PV'")},
        h AS (SELECT {GROUP_SQL}, [max("values"[1]), min("values"[1]),
                (sum("values"[1]::DOUBLE) / count(*))::FLOAT] AS stats FROM b GROUP BY {GROUP_SQL})
        SELECT rep.* EXCLUDE (bucket, rn) REPLACE (stats AS "values") FROM rep JOIN h USING ({GROUP_SQL}))"""


def channels_sql(bucket_ms: int) -> str:
    return f"""(WITH {last_pair_sql(bucket_ms, "\"sensorType\" = 'HPRESS'")},
        h AS (SELECT {GROUP_SQL}, [max("values"[1]), min("values"[1]),
                (sum("values"[1]::DOUBLE) / count(*))::FLOAT, max("values"[2]), min("values"[2]),
                (sum("values"[2]::DOUBLE) / count(*))::FLOAT] AS stats FROM b GROUP BY {GROUP_SQL})
        SELECT rep.* EXCLUDE (bucket, rn) REPLACE (stats AS "values") FROM rep JOIN h USING ({GROUP_SQL}))"""


def earliest_job_sql(sample: str, detail: str) -> str:
    return (
        f"SELECT * FROM ({_newest(earliest_sql(SECOND_MS), repr(sample), SECOND_MS)})"
        f" UNION ALL SELECT * FROM ({_newest('readings', repr(detail), None)})"
    )


SAMPLE_TABLE_SQL = "'BRIDGE_' || terminal || '_1S'"

BRIDGE_1S_SQL = (
    f"SELECT * FROM ({_newest('readings', DETAIL_TABLE_SQL, None)}) UNION ALL"
    f" SELECT * FROM ({_newest(head_sql(SECOND_MS), SAMPLE_TABLE_SQL, SECOND_MS)})"
)


@query("job_bridge_1s", BRIDGE_1S_SQL)
def job_bridge_1s(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "bridge_1s"))


@query(
    "job_bridge_1s_messages",
    f"SELECT coalesce({TOPIC_SQL}, 'UNROUTED') AS topic, {JSON_SQL} AS value FROM {head_sql(SECOND_MS)}",
)
def job_bridge_1s_messages(spark, sf_dir):
    """Every message that the job sends, those that no topic wants included."""
    root = _run(spark, sf_dir, "bridge_1s")
    sent = spark.read.schema(MESSAGE).parquet(f"{root}/messages")
    return sent.select("topic", F.col("value").cast("string").alias("value"))


BRIDGE_10M_SQL = (
    f"SELECT * FROM ({_newest(head_sql(TEN_MINUTES_MS), repr('BRIDGE_TENDENCY_10M'), TEN_MINUTES_MS)})"
    " UNION ALL SELECT * FROM ("
    + _newest(
        "(SELECT * FROM readings WHERE \"dataType\" = 'S10M')",
        repr("BRIDGE_FEATURE_10M"),
        TEN_MINUTES_MS,
    )
    + ")"
)


@query("job_bridge_10m", BRIDGE_10M_SQL)
def job_bridge_10m(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "bridge_10m"))


@query("job_bridge_detail", _newest("readings", repr("BRIDGE_DETAIL"), None))
def job_bridge_detail(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "bridge_detail"))


@query("job_gas_1s", earliest_job_sql("GAS_1S", "GAS"))
def job_gas_1s(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "gas_1s"))


@query("job_drain_1s", earliest_job_sql("DRAIN_1S", "DRAIN"))
def job_drain_1s(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "drain_1s"))


@query("job_heat_1s", earliest_job_sql("HEAT_1S", "HEAT"))
def job_heat_1s(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "heat_1s"))


WATER_ROWS_SQL = (
    f"(SELECT * EXCLUDE (rank_col) FROM (SELECT *, 0 AS rank_col FROM {channels_sql(SECOND_MS)})"
    " UNION ALL BY NAME SELECT * FROM readings WHERE \"sensorType\" <> 'HPRESS')"
)


@query(
    "job_water_1s",
    f"SELECT * FROM ({_newest(WATER_ROWS_SQL, repr('WATER_1S'), SECOND_MS)})"
    f" UNION ALL SELECT * FROM ({_newest('readings', repr('WATER'), None)})",
)
def job_water_1s(spark, sf_dir):
    return _stored(spark, _run(spark, sf_dir, "water_1s"))


@query(
    "job_water_flow",
    f"SELECT * EXCLUDE (seconds) FROM ({_newest(earliest_sql(HOUR_MS), repr('WATER_FLOW'), HOUR_MS)})",
)
def job_water_flow(spark, sf_dir):
    columns = ["table_name", "rowkey", *FLOW_COLUMNS]
    return _stored(spark, _run(spark, sf_dir, "water_flow"), columns)


FIRST, LAST = "20240104", "20240127"
IN_DAYS = f"strftime(make_timestamp_ms(time), '%Y%m%d') BETWEEN '{FIRST}' AND '{LAST}'"

#: Day tables as backfills read them: flow sensors have one channel; RMS rows are features.
DAY_ROWS_SQL = f"""(SELECT * REPLACE (CASE WHEN "sensorType" = 'FLOW' THEN "values"[1:1] ELSE "values" END AS "values",
      CASE WHEN "dataType" = 'RMS' THEN 'S10M' ELSE "sensorType" END AS "sensorType") FROM readings WHERE {IN_DAYS})"""


def _backfill_tables(spark, sf_dir):
    """The day tables with the channels and features that :data:`DAY_ROWS_SQL` gives them."""
    one_channel = F.when(F.col("c4") == "FLOW", F.slice("c10", 1, 1)).otherwise(F.col("c10"))
    kind = F.when(F.col("c5") == "RMS", F.lit("S10M")).otherwise(F.col("c4"))
    return {n: t.withColumns({"c10": one_channel, "c4": kind}) for n, t in day_tables(spark, sf_dir).items()}


def _conditional_sql(bucket_ms: int) -> str:
    """Representatives of each day and table; those with one channel have its statistics as values."""
    source = f"""(SELECT *, time // {DAY} AS dt, seq AS s FROM {DAY_ROWS_SQL})"""
    sql = f"""(WITH {last_pair_sql(bucket_ms, source=source)},
        h AS (SELECT {GROUP_SQL}, [max("values"[1]), min("values"[1]),
                (sum("values"[1]::DOUBLE) / count(*))::FLOAT] AS stats FROM b GROUP BY {GROUP_SQL})
        SELECT rep.* EXCLUDE (bucket, rn) REPLACE (if(len("values") = 1, stats, "values") AS "values")
        FROM rep JOIN h USING ({GROUP_SQL}))"""
    return sql.replace(GROUP_SQL, f"{GROUP_SQL}, dt")


@query(
    "job_bridge_backfill",
    f"""SELECT * FROM ({_newest(_conditional_sql(SECOND_MS), SAMPLE_TABLE_SQL, None)}) UNION ALL
      SELECT * FROM ({_newest(_conditional_sql(TEN_MINUTES_MS), repr("BRIDGE_TENDENCY_10M"), None)}) UNION ALL
      SELECT * FROM ({_newest(f"(SELECT * FROM {DAY_ROWS_SQL} WHERE {chr(34)}sensorType{chr(34)} = 'S10M')",
                              repr("BRIDGE_FEATURE_10M"), None)})""",
)
def job_bridge_backfill(spark, sf_dir):
    """Second, ten-minute and feature tables of the days in the middle of the month."""
    root = shared_folder(spark, "bridge_backfill")
    run_backfill(bridge_backfill(_backfill_tables(spark, sf_dir), FIRST, LAST), root)
    return current(spark, root).select(*STORED)


@query(
    "job_bridge_backfill_sampled",
    f"""SELECT * FROM ({_newest(_conditional_sql(12 * HOUR_MS), SAMPLE_TABLE_SQL, None)}) UNION ALL
      SELECT * FROM ({_newest(_conditional_sql(24 * HOUR_MS), repr("BRIDGE_TENDENCY_10M"), None)}) UNION ALL
      SELECT * FROM ({_newest(f"(SELECT * FROM {DAY_ROWS_SQL} WHERE {chr(34)}sensorType{chr(34)} = 'S10M')",
                              repr("BRIDGE_FEATURE_10M"), None)})""",
)
def job_bridge_backfill_sampled(spark, sf_dir):
    """As above with half a day and a day as buckets, which hold several readings."""
    root = shared_folder(spark, "bridge_backfill")
    tables = _backfill_tables(spark, sf_dir)
    run_backfill(bridge_backfill(tables, FIRST, LAST, fine_ms=12 * HOUR_MS, coarse_ms=24 * HOUR_MS), root)
    return current(spark, root).select(*STORED)


@query(
    "job_gaswater_backfill",
    f"SELECT * FROM ({_newest(earliest_sql(SECOND_MS).replace('WHERE TRUE', f'WHERE {IN_DAYS}'), repr('GAS_1S'), None)})",
)
def job_gaswater_backfill(spark, sf_dir):
    root = shared_folder(spark, "gaswater_backfill")
    run_backfill(earliest_backfill(day_tables(spark, sf_dir), FIRST, LAST, "GAS_1S"), root)
    return current(spark, root).select(*STORED)


# --- several micro-batches, with buckets that hold several readings ------------------------------------

BATCH_ORDER = "batch DESC, time DESC, rtime DESC, seq DESC"


def per_batch(sql: str) -> str:
    """A sampler's SQL over the readings, applied to each batch of arrival alone."""
    return sql.replace("FROM readings", "FROM arrived").replace(GROUP_SQL, f"{GROUP_SQL}, batch")


def _last_written(rows: str, table: str, floor_ms: int | None) -> str:
    """As :func:`_newest`; a later batch replaces what earlier ones wrote."""
    inner = f"SELECT *, {table} AS tab, {rowkey_sql(floor_ms)} AS rk FROM {rows}"
    return stored_sql(table, floor_ms, f"({newest_sql(f'({inner})', BATCH_ORDER)})")


def _in_batches(spark, sf_dir, name, bucket_ms, delay_ms=None):
    """Run a job over the four batches of arrival; returns the folder of its outputs."""
    spec = replace(JOBS[name].with_bucket(bucket_ms), topics=tuple(TOPICS))
    root = shared_folder(spark, name)
    source = batched_topic_stream(spark, spec.topics, sf_dir)
    if delay_ms is None:
        job = start_job(spec, decode_json(source), root, f"{root}/positions")
    else:
        job = start_exact_job(spec, decode_json(source), root, f"{root}/positions", delay_ms)
    job.awaitTermination()
    return root


@query(
    "batch_scoped_last_writer",
    f", {ARRIVED_SQL} SELECT * FROM ({_last_written(per_batch(earliest_sql(5 * DAY)), repr('GAS_1S'), 5 * DAY)})"
    f" UNION ALL SELECT * FROM ({_last_written('arrived', repr('GAS'), None)})",
)
def batch_scoped_last_writer(spark, sf_dir):
    """The gas job with five-day buckets: the earliest reading of the last batch that has the bucket."""
    return _stored(spark, _in_batches(spark, sf_dir, "gas_1s", 5 * DAY))


@query(
    "late_overwrite",
    f", {ARRIVED_SQL}, e AS (SELECT *, max(batch) OVER (PARTITION BY sensor, terminal, time // {DAY}) AS last"
    f" FROM {per_batch(earliest_sql(DAY))}),"
    f" s AS ({_last_written('e', repr('WATER_FLOW'), DAY)}) SELECT * EXCLUDE (seconds) FROM s",
)
def late_overwrite(spark, sf_dir):
    """The flow job with one-day buckets: late readings form a partial bucket that replaces the row."""
    columns = ["table_name", "rowkey", *FLOW_COLUMNS]
    return _stored(spark, _in_batches(spark, sf_dir, "water_flow", DAY), columns)


@query(
    "batches_bridge_1s",
    f", {ARRIVED_SQL} SELECT * FROM ({_last_written(per_batch(head_sql(DAY)), SAMPLE_TABLE_SQL, DAY)})"
    f" UNION ALL SELECT * FROM ({_last_written('arrived', DETAIL_TABLE_SQL, None)})",
)
def batches_bridge_1s(spark, sf_dir):
    return _stored(spark, _in_batches(spark, sf_dir, "bridge_1s", DAY))


@query(
    "batches_water_1s",
    f", {ARRIVED_SQL}, w AS (SELECT location, terminal, sensor, rtime, \"sensorType\", \"dataType\", monitoring, time,"
    f" level, \"values\", seq, batch FROM {per_batch(channels_sql(DAY))} UNION ALL BY NAME"
    " SELECT * FROM arrived WHERE \"sensorType\" <> 'HPRESS')"
    f" SELECT * FROM ({_last_written('w', repr('WATER_1S'), DAY)})"
    f" UNION ALL SELECT * FROM ({_last_written('arrived', repr('WATER'), None)})",
)
def batches_water_1s(spark, sf_dir):
    return _stored(spark, _in_batches(spark, sf_dir, "water_1s", DAY))


# --- exact buckets over all batches ----------------------------------------------------------------------

DELAY = 2 * DAY


def exact_sql(bucket_ms: int) -> str:
    """``in_time`` and ``late``: readings of buckets that the watermark has not passed before their
    batch, and the others; ``closed``: those of ``in_time`` in buckets that it has passed in the end."""
    return f"""{ARRIVED_SQL},
      seen AS (SELECT n AS batch, max(time) AS seen FROM range(0, 4) r(n) LEFT JOIN arrived ON batch < n GROUP BY n),
      told AS (SELECT *, time // {bucket_ms} < (seen - {DELAY}) // {bucket_ms} AS is_late
               FROM arrived JOIN seen USING (batch)),
      in_time AS (SELECT * EXCLUDE (seen, is_late) FROM told WHERE coalesce(NOT is_late, TRUE)),
      late AS (SELECT * EXCLUDE (seen, is_late) FROM told WHERE is_late),
      closed AS (SELECT * FROM in_time
                 WHERE time // {bucket_ms} < ((SELECT max(time) FROM arrived) - {DELAY}) // {bucket_ms})"""


def exactly(sql: str) -> str:
    return sql.replace("FROM readings", "FROM closed")


@query(
    "exact_job_bridge",
    f", {exact_sql(DAY)} SELECT * FROM ({_newest(exactly(head_sql(DAY)), SAMPLE_TABLE_SQL, DAY)})"
    f" UNION ALL SELECT * FROM ({_last_written('arrived', DETAIL_TABLE_SQL, None)})",
)
def exact_job_bridge(spark, sf_dir):
    """The bridge job with the last pair of each closed day over all four batches."""
    return _stored(spark, _in_batches(spark, sf_dir, "bridge_1s", DAY, DELAY))


@query(
    "exact_job_water",
    f", {exact_sql(DAY)} SELECT * FROM ({_newest(exactly(channels_sql(DAY)), repr('WATER_1S'), DAY)})",
)
def exact_job_water(spark, sf_dir):
    """Pressure of the water job: all channels of each closed day over all four batches."""
    root = _in_batches(spark, sf_dir, "water_1s", DAY, DELAY)
    rows = _stored(spark, root, [*STORED])
    return rows.where("table_name = 'WATER_1S' AND sensorType = 'HPRESS'")


@query(
    "exact_job_water_flow",
    f", {exact_sql(5 * DAY)}, s AS ({_newest(exactly(earliest_sql(5 * DAY)), repr('WATER_FLOW'), 5 * DAY)})"
    " SELECT * EXCLUDE (seconds) FROM s",
)
def exact_job_water_flow(spark, sf_dir):
    """The flow job: the earliest reading of each closed five days, whatever batch it came in."""
    columns = ["table_name", "rowkey", *FLOW_COLUMNS]
    return _stored(spark, _in_batches(spark, sf_dir, "water_flow", 5 * DAY, DELAY), columns)


@query(
    "late_output",
    f", {exact_sql(5 * DAY)} SELECT seq, time, rtime, sensor, level, batch::BIGINT AS batch_id FROM late",
)
def late_output(spark, sf_dir):
    """Readings of the flow job that came after their bucket had been given out."""
    root = _in_batches(spark, sf_dir, "water_flow", 5 * DAY, DELAY)
    late = late_readings(spark, root)
    return late.select(
        F.col("seq.offset").alias("seq"), "time", "rtime", "sensor", "level", F.col("batch_id").cast("bigint")
    )

"""Routing, keyed rows and what the stores hold in the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAY,
    GROUP_SQL,
    JSON_SQL,
    SECOND_TEXT_SQL,
    TIME_TEXT_SQL,
    VALUES_TEXT_SQL,
    day_tables,
    mixed_readings,
    newest_sql,
    query,
    readings,
    rowkey_sql,
    stored_sql,
)
from catalog.sampling import HEAD_SQL, bucketed_sql, last_pair_sql
from gaugeflow.operators import filters, routing, sampling
from gaugeflow.operators.lookup import topic_map, with_topic
from gaugeflow.plans.backfill import bridge_backfill, earliest_backfill, run_backfill
from gaugeflow.plans.jobs import JOBS
from gaugeflow.plans.runner import keyed, sampled
from gaugeflow.schema import FLOW_COLUMNS, HOUR_MS, SECOND_MS, STORED_COLUMNS, TEN_MINUTES_MS
from gaugeflow.session import shared_folder
from gaugeflow.sinks.cells import sorted_cells
from gaugeflow.sinks.changes import current, write_changes
from gaugeflow.sinks.messages import message_rows, split_unrouted

STORED = ["table_name", "rowkey", *STORED_COLUMNS]

TOPIC_SQL = (
    "CASE WHEN monitoring IN ('ACCE', 'DYNDEF', 'DISPMT', 'LOWSUMRY', 'STRAIN')"
    " THEN 'CLLSEN-BRIDGE-HF-' || monitoring || '-HIVE' END"
)

DETAIL_TABLE_SQL = (
    "CASE \"dataType\" WHEN 'PV' THEN 'BRIDGE_' || terminal WHEN 'FFT' THEN 'BRIDGE_FFT'"
    " ELSE 'BRIDGE_OTHER_DATATYPE' END"
)


@query("topic_lookup", f"SELECT seq, monitoring, {TOPIC_SQL} AS topic FROM readings")
def topic_lookup(spark, sf_dir):
    rows = with_topic(readings(spark, sf_dir), topic_map())
    return rows.select("seq", "monitoring", "topic")


# Two monitoring names share one topic, as a setting with a list gives.
@query(
    "topic_lookup_list",
    "SELECT topic, count(*) AS n FROM (SELECT CASE monitoring"
    " WHEN 'ACCE' THEN 'CLLSEN-BRIDGE-HF-ACCE-HIVE' WHEN 'UNMAPPED' THEN 'CLLSEN-BRIDGE-HF-ACCE-HIVE'"
    " WHEN 'DYNDEF' THEN 'CLLSEN-BRIDGE-HF-DYNDEF-HIVE' WHEN 'DISPMT' THEN"
    " 'CLLSEN-BRIDGE-HF-DISPMT-HIVE' WHEN 'STRAIN' THEN 'CLLSEN-BRIDGE-HF-STRAIN-HIVE' END AS topic"
    " FROM readings) GROUP BY ALL",
)
def topic_lookup_list(spark, sf_dir):
    topics = topic_map({"acce": "ACCE,UNMAPPED", "lowsumary": "LOWSUMY"})
    return with_topic(readings(spark, sf_dir), topics).groupBy("topic").agg(F.count("*").alias("n"))


WATER_SQL = f""", {last_pair_sql(DAY, "\"sensorType\" = 'HPRESS'")},
    raw AS (SELECT * FROM readings WHERE "sensorType" <> 'HPRESS')
    SELECT {rowkey_sql(DAY)} AS rowkey, seq, "sensorType", level FROM rep
    UNION ALL SELECT {rowkey_sql(DAY)}, seq, "sensorType", level FROM raw"""


@query("water_1s_union", WATER_SQL)
def water_union(spark, sf_dir):
    """Sampled pressure readings and all others, on their way into one table."""
    spec = JOBS["water_1s"].with_bucket(DAY)
    rows = readings(spark, sf_dir)
    pressure, others = [keyed(spec, o, sampled(spec, o, rows)) for o in spec.outputs[:2]]
    return pressure.unionByName(others).select("rowkey", "seq", "sensorType", "level")


@query("route_bridge_detail", f"SELECT seq, {DETAIL_TABLE_SQL} AS table_name FROM readings")
def route_bridge_detail(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", routing.bridge_detail_table().alias("table_name"))


@query(
    "route_bridge_detail_legacy",
    "SELECT seq, CASE \"dataType\" WHEN 'PV' THEN 'BRIDGE_' || terminal WHEN 'FFT' THEN 'BRIDGE_FFT'"
    " WHEN 'S10M' THEN 'BRIDGE_' || terminal || '_' ELSE 'BRIDGE_OTHER_DATATYPE' END AS table_name"
    " FROM readings",
)
def route_bridge_detail_legacy(spark, sf_dir):
    table = routing.bridge_detail_table(legacy_names=True)
    return readings(spark, sf_dir).select("seq", table.alias("table_name"))


@query("route_bridge_sample", "SELECT seq, 'BRIDGE_' || terminal || '_1S' AS table_name FROM readings")
def route_bridge_sample(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", routing.bridge_sample_table().alias("table_name"))


@query(
    "route_10m",
    "SELECT seq, 'BRIDGE_TENDENCY_10M' AS table_name, 'CLLSEN-BRIDGE-HF-TENDENCY' AS topic"
    " FROM readings WHERE \"dataType\" = 'PV' UNION ALL"
    " SELECT seq, 'BRIDGE_FEATURE_10M', 'CLLSEN-BRIDGE-HF-FEATURE' FROM readings"
    " WHERE \"dataType\" = 'S10M'",
)
def route_10m(spark, sf_dir):
    rows = readings(spark, sf_dir)
    parts = [
        filters.FILTERS[o.rows](rows).select(
            "seq", F.lit(o.table).alias("table_name"), F.lit(o.topic).alias("topic")
        )
        for o in JOBS["bridge_10m"].outputs
    ]
    return parts[0].unionByName(parts[1])


@query(
    "route_sample_kind",
    f"SELECT seq, 'GAS_1S' AS table_name, {rowkey_sql(SECOND_MS)} AS rowkey FROM readings"
    f" UNION ALL SELECT seq, 'GAS', {rowkey_sql(None)} FROM readings",
)
def route_sample_kind(spark, sf_dir):
    """Sample tables get floored keys, detail tables exact ones."""
    rows = readings(spark, sf_dir)
    parts = []
    for table in ("GAS_1S", "GAS"):
        floor = SECOND_MS if routing.kind_of(table) == routing.SAMPLE else None
        parts.append(routing.stored_rows(rows, table, floor).select("seq", "table_name", "rowkey"))
    return parts[0].unionByName(parts[1])


@query(
    "rows_per_table", f"SELECT {DETAIL_TABLE_SQL} AS table_name, count(*) AS n FROM readings GROUP BY ALL"
)
def rows_per_table(spark, sf_dir):
    rows = routing.stored_rows(readings(spark, sf_dir), routing.bridge_detail_table(), None)
    return routing.rows_per_table(rows)


@query("detail_rows", stored_sql(DETAIL_TABLE_SQL, None, "readings"))
def detail_rows(spark, sf_dir):
    rows = routing.stored_rows(readings(spark, sf_dir), routing.bridge_detail_table(), None)
    return rows.select(*STORED)


@query(
    "flow_columns",
    f", {bucketed_sql(HOUR_MS)}, e AS (SELECT * FROM b QUALIFY row_number() OVER"
    f" (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1),"
    f" s AS ({stored_sql(chr(39) + 'WATER_FLOW' + chr(39), HOUR_MS, 'e')})"
    " SELECT * EXCLUDE (seconds) FROM s",
)
def flow_columns(spark, sf_dir):
    spec = JOBS["water_flow"]
    (output,) = spec.outputs
    rows = keyed(spec, output, sampled(spec, output, readings(spark, sf_dir)))
    return rows.select("table_name", "rowkey", *FLOW_COLUMNS)


@query(
    "message_rows",
    f"SELECT {TOPIC_SQL} AS topic, {JSON_SQL} AS value FROM readings",
)
def messages_out(spark, sf_dir):
    rows = with_topic(readings(spark, sf_dir), topic_map())
    out = message_rows(rows, F.col("topic"))
    return out.select("topic", F.col("value").cast("string").alias("value"))


@query("unrouted_messages", f"SELECT {JSON_SQL} AS value FROM readings WHERE monitoring = 'UNMAPPED'")
def unrouted_messages(spark, sf_dir):
    rows = with_topic(readings(spark, sf_dir), topic_map())
    _, unrouted = split_unrouted(message_rows(rows, F.col("topic")))
    return unrouted.select(F.col("value").cast("string").alias("value"))


SHIFT_MS = 8 * HOUR_MS


def _in_shifts(spark, rows, label):
    """Write rows in three batches: what came in the first, second, third part of a day."""
    root = shared_folder(spark, label)
    shift = F.expr(f"event_time div {SHIFT_MS}") % 3
    for batch_id in range(3):
        write_changes(rows.where(shift == batch_id), root, batch_id)
    return root, rows.where(shift == 2)


UPSERT_ORDER = f"time // {SHIFT_MS} % 3 DESC, time DESC, rtime DESC, seq DESC"


@query(
    "upsert_current",
    f", k AS (SELECT *, {DETAIL_TABLE_SQL} AS tab, {rowkey_sql(DAY)} AS rk FROM readings),"
    f" n AS ({newest_sql('k', UPSERT_ORDER)})"
    " SELECT tab AS table_name, rk AS rowkey, seq, level FROM n",
)
def upsert_current(spark, sf_dir):
    """Three batches with day-floored keys; the last batch is written twice."""
    rows = routing.stored_rows(readings(spark, sf_dir), routing.bridge_detail_table(), DAY)
    root, last = _in_shifts(spark, rows, "upsert")
    write_changes(last, root, 2)
    return current(spark, root).select("table_name", "rowkey", "seq", "level")


@query(
    "upsert_compacted",
    f", k AS (SELECT *, {DETAIL_TABLE_SQL} AS tab, {rowkey_sql(DAY)} AS rk FROM readings),"
    f" n AS ({newest_sql('k', UPSERT_ORDER)})"
    " SELECT tab AS table_name, rk AS rowkey, seq, level FROM n",
)
def upsert_compacted(spark, sf_dir):
    """The current rows of the first two batches, copied to a new store, and then the last one."""
    rows = routing.stored_rows(readings(spark, sf_dir), routing.bridge_detail_table(), DAY)
    root = shared_folder(spark, "first")
    shift = F.expr(f"event_time div {SHIFT_MS}") % 3
    for batch_id in range(2):
        write_changes(rows.where(shift == batch_id), root, batch_id)
    copied = shared_folder(spark, "compacted")
    write_changes(current(spark, root), copied, 0, "copy")
    write_changes(rows.where(shift == 2), copied, 0, "stream")
    return current(spark, copied).select("table_name", "rowkey", "seq", "level")


def _writes_sql(floor: dict[int, int | None], order: str) -> str:
    """Current rows after a write of each part of the readings, in the order of ``order``; parts are
    numbered by their third of a day, and have row keys floored as ``floor`` says."""
    keys = " ".join(f"WHEN {part} THEN {rowkey_sql(ms)}" for part, ms in floor.items())
    return (
        f", k AS (SELECT *, {DETAIL_TABLE_SQL} AS tab, CASE time // {SHIFT_MS} % 3 {keys} END AS rk FROM readings),"
        f" n AS ({newest_sql('k', f'{order}, time DESC, rtime DESC, seq DESC')})"
        " SELECT tab AS table_name, rk AS rowkey, seq, level FROM n"
    )


@query(
    "store_two_writers",
    _writes_sql({0: DAY, 1: DAY, 2: DAY}, f"CASE time // {SHIFT_MS} % 3 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END DESC"),
)
def store_two_writers(spark, sf_dir):
    """Writes of a stream A and another B in turn, A, B, A: the last write of a key stays, A's here."""
    rows = routing.stored_rows(readings(spark, sf_dir), routing.bridge_detail_table(), DAY)
    root = shared_folder(spark, "writers")
    shift = F.expr(f"event_time div {SHIFT_MS}") % 3
    for part, writer, batch_id in ((0, "A", 0), (1, "A", 7), (2, "B", 0), (0, "A", 8)):
        write_changes(rows.where(shift == part), root, batch_id, writer)
    return current(spark, root).select("table_name", "rowkey", "seq", "level")


@query(
    "backfill_beside_stream",
    f""", {bucketed_sql(DAY)}, e AS (SELECT * FROM b QUALIFY row_number() OVER
        (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1),
      w AS (SELECT * EXCLUDE (bucket), 1 AS written, 'GAS_1S' AS tab FROM e
        UNION ALL SELECT *, CASE time // {SHIFT_MS} % 3 WHEN 0 THEN 0 ELSE 2 END, 'GAS_1S' FROM readings
          WHERE time // {SHIFT_MS} % 3 < 2
        UNION ALL SELECT *, 3, 'GAS_10M' FROM readings),
      k AS (SELECT *, CASE tab WHEN 'GAS_1S' THEN {rowkey_sql(DAY)} ELSE {rowkey_sql(None)} END AS rk FROM w),
      n AS ({newest_sql('k', "written DESC, time DESC, rtime DESC")})
      SELECT tab AS table_name, rk AS rowkey, time AS event_time, level FROM n""",
)
def backfill_beside_stream(spark, sf_dir):
    """A stream, a floored backfill of the same keys, the stream again, and a backfill of another
    bucket and table: nothing is lost, and the last write of each key stays."""
    rows = routing.stored_rows(readings(spark, sf_dir), "GAS_1S", DAY)
    root = shared_folder(spark, "beside")
    shift = F.expr(f"event_time div {SHIFT_MS}") % 3
    tables = day_tables(spark, sf_dir)
    write_changes(rows.where(shift == 0), root, 0, "stream")
    run_backfill(earliest_backfill(tables, *DAYS, "GAS_1S", DAY, floor_key=True), root)
    write_changes(rows.where(shift == 1), root, 1, "stream")
    run_backfill(earliest_backfill(tables, *DAYS, "GAS_10M", SECOND_MS), root)
    return current(spark, root).select("table_name", "rowkey", "event_time", "level")


CELL_KINDS = {
    "location": "location",
    "seconds": SECOND_TEXT_SQL,
    "time": TIME_TEXT_SQL,
    "sensorType": '"sensorType"',
    "dataType": '"dataType"',
    "monitoring": "monitoring",
    "values": VALUES_TEXT_SQL,
}


def _cells_sql(table: str, floor_ms: int | None, source: str, without: tuple[str, ...] = ()) -> str:
    parts = {name: f"hex({text})" for name, text in CELL_KINDS.items()}
    parts["rtime"] = "lpad(hex(rtime), 16, '0')"
    parts["level"] = "right(lpad(hex(level::BIGINT), 16, '0'), 8)"
    return " UNION ALL ".join(
        f"SELECT {table} AS table_name, {rowkey_sql(floor_ms)} AS rowkey, 'M' AS family, '{name}' AS qualifier,"
        f" {cell} AS bytes FROM {source}"
        for name, cell in parts.items()
        if name not in without
    )


@query(
    "cell_rows",
    f""", {bucketed_sql(HOUR_MS)}, e AS (SELECT * FROM b QUALIFY row_number() OVER
        (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1)
      {_cells_sql("'GAS'", None, "readings")} UNION ALL {_cells_sql("'WATER_FLOW'", HOUR_MS, "e", ("seconds",))}""",
)
def cells_of_all_rows(spark, sf_dir):
    """All cells of the raw gas table, nine a row, and of the flow table, eight a row."""
    rows = readings(spark, sf_dir)
    spec = JOBS["water_flow"]
    (output,) = spec.outputs
    tables = (routing.stored_rows(rows, "GAS", None), keyed(spec, output, sampled(spec, output, rows)))
    cells = tables[0].transform(sorted_cells).unionByName(tables[1].transform(sorted_cells))
    return cells.withColumn("bytes", F.hex("value")).drop("value")


@query(
    "feature_last",
    f", k AS (SELECT *, 'BRIDGE_FEATURE_10M' AS tab, {rowkey_sql(TEN_MINUTES_MS)} AS rk FROM readings"
    f" WHERE \"dataType\" = 'S10M'), n AS ({newest_sql('k')})"
    f" {stored_sql('tab', TEN_MINUTES_MS, 'n')}",
)
def feature_last(spark, sf_dir):
    """Feature rows are not sampled, but the last one of a bucket stays."""
    spec = JOBS["bridge_10m"]
    output = spec.outputs[1]
    root = shared_folder(spark, "feature")
    write_changes(keyed(spec, output, sampled(spec, output, readings(spark, sf_dir))), root, 0)
    return current(spark, root).select(*STORED)


DAYS = ("20240101", "20240131")

BACKFILL_SQL = f""", mixed AS (SELECT * REPLACE (CASE WHEN "sensorType" = 'FLOW' THEN
      "values"[1:1] ELSE "values" END AS "values") FROM readings)"""


def _backfill_sql(bucket_ms: int, table: str) -> str:
    return f"""SELECT {table} AS table_name, {rowkey_sql(None)} AS rowkey, level, time AS event_time,
        "dataType" FROM (WITH {bucketed_sql(bucket_ms)}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY {GROUP_SQL} ORDER BY time DESC, rtime DESC) AS rn FROM b)
        SELECT * FROM ranked WHERE rn <= 2 QUALIFY row_number() OVER
        (PARTITION BY {GROUP_SQL} ORDER BY level DESC, rn) = 1)"""


@query(
    "backfill_rows",
    f"""{_backfill_sql(HOUR_MS, "'BRIDGE_' || terminal || '_1S'")}
      UNION ALL {_backfill_sql(12 * HOUR_MS, "'BRIDGE_TENDENCY_10M'")}
      UNION ALL SELECT 'BRIDGE_FEATURE_10M', {rowkey_sql(None)}, level, time, "dataType"
      FROM readings WHERE "dataType" = 'S10M'""",
)
def backfill_rows(spark, sf_dir):
    """Bucket sizes of one and twelve hours, and features by data type."""
    rows = bridge_backfill(
        day_tables(spark, sf_dir),
        *DAYS,
        fine_ms=HOUR_MS,
        coarse_ms=12 * HOUR_MS,
        feature_column="dataType",
    )
    return rows.select("table_name", "rowkey", "level", "event_time", "dataType")


@query(
    "backfill_earliest",
    f", {bucketed_sql(DAY)} SELECT 'GAS_1S' AS table_name, {rowkey_sql(None)} AS rowkey, level,"
    " time AS event_time"
    f" FROM b QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1",
)
def backfill_earliest(spark, sf_dir):
    rows = earliest_backfill(day_tables(spark, sf_dir), *DAYS, "GAS_1S", DAY)
    return rows.select("table_name", "rowkey", "level", "event_time")


@query(
    "conditional_rows",
    f"{BACKFILL_SQL}, {last_pair_sql(DAY, source='mixed')}, {HEAD_SQL}"
    f" SELECT {rowkey_sql(None)} AS rowkey, level, n FROM"
    ' (SELECT *, CAST(if(len("values") = 1, 3, len("values")) AS INT) AS n FROM rep)',
)
def conditional_rows(spark, sf_dir):
    """How many values each backfilled row has."""
    rows = sampling.conditional_stats(mixed_readings(spark, sf_dir), DAY)
    out = routing.stored_rows(rows, routing.bridge_sample_table(), None)
    return out.select("rowkey", "level", F.size(F.split("values", ",")).alias("n"))

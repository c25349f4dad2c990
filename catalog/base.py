"""Registration of queries, and the readings they run on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schema import MESSAGE, READING_COLUMNS
from gaugeflow.session import shared_folder
from gaugeflow.sinks.folders import matching
from gaugeflow.sources.messages import topic_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. ``sql`` may use the views defined below."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = f"WITH {READINGS_SQL}, {MESSAGES_SQL} {sql}"
        return fn

    return register


# --- readings -----------------------------------------------------------------

READING_EXPRESSIONS = {
    "location": "concat('L', cast(user_id % 4 AS string))",
    "terminal": "concat('T', cast(user_id % 16 AS string))",
    "sensor": "concat('S', cast(user_id AS string))",
    "rtime": "unix_millis(cast(ts AS timestamp)) + event_id % 500",
    "sensorType": "CASE WHEN user_id % 2 = 0 THEN 'HPRESS' ELSE 'FLOW' END",
    "dataType": """CASE event_type WHEN 'click' THEN 'PV' WHEN 'view' THEN 'PV'
        WHEN 'purchase' THEN 'FFT' WHEN 'signup' THEN 'S10M' ELSE 'RMS' END""",
    "monitoring": """CASE user_id % 6 WHEN 0 THEN 'ACCE' WHEN 1 THEN 'DYNDEF' WHEN 2 THEN 'DISPMT'
        WHEN 3 THEN 'LOWSUMRY' WHEN 4 THEN 'STRAIN' ELSE 'UNMAPPED' END""",
    "time": "unix_millis(cast(ts AS timestamp))",
    "level": "cast(get_json_object(props, '$.k') AS int) % 4",
    "values": "array(cast(value AS float), cast(value * 2 AS float))",
    "seq": "event_id",
}

READINGS_SQL = """readings AS (
  SELECT 'L' || (user_id % 4) AS location, 'T' || (user_id % 16) AS terminal,
         'S' || user_id AS sensor, epoch_us(ts)//1000 + event_id % 500 AS rtime,
         CASE WHEN user_id % 2 = 0 THEN 'HPRESS' ELSE 'FLOW' END AS "sensorType",
         CASE event_type WHEN 'click' THEN 'PV' WHEN 'view' THEN 'PV' WHEN 'purchase' THEN 'FFT'
                         WHEN 'signup' THEN 'S10M' ELSE 'RMS' END AS "dataType",
         CASE user_id % 6 WHEN 0 THEN 'ACCE' WHEN 1 THEN 'DYNDEF' WHEN 2 THEN 'DISPMT'
                          WHEN 3 THEN 'LOWSUMRY' WHEN 4 THEN 'STRAIN' ELSE 'UNMAPPED'
                          END AS monitoring,
         epoch_us(ts)//1000 AS time, CAST(props->>'$.k' AS INT) % 4 AS level,
         [CAST(value AS FLOAT), CAST(value * 2 AS FLOAT)] AS "values", event_id AS seq
  FROM events)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as sensor readings."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(*[f"{e} AS `{name}`" for name, e in READING_EXPRESSIONS.items()])


def mixed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`readings`; flow sensors have one channel, pressure sensors two."""
    one = F.slice("values", 1, 1)
    return readings(spark, sf_dir).withColumn(
        "values", F.when(F.col("sensorType") == "FLOW", one).otherwise(F.col("values"))
    )


# --- SQL pieces ---------------------------------------------------------------

DAY = 86_400_000

PREFIX_SQL = "substr(md5(sensor || terminal), 1, 6)"
TIME_TEXT_SQL = "strftime(make_timestamp_ms(time), '%Y-%m-%d %H:%M:%S:%g')"
SECOND_TEXT_SQL = "strftime(make_timestamp_ms(time), '%S')"
VALUES_TEXT_SQL = "array_to_string(list_transform(\"values\", lambda v: v::varchar), ',')"
GROUP_SQL = "location, terminal, sensor, bucket"


def rowkey_sql(floor_ms: int | None) -> str:
    time = f"time//{floor_ms}*{floor_ms}" if floor_ms else "time"
    return (
        f"{PREFIX_SQL} || ':' || terminal || ':' || sensor || ':' || "
        f"(9223372036854775807 - {time})"
    )


JSON_SQL = (
    """'{"location":"' || location || '","terminal":"' || terminal || '","sensor":"' || sensor"""
    """ || '","rtime":' || rtime || ',"sensorType":"' || "sensorType" || '","dataType":"'"""
    """ || "dataType" || '","monitoring":"' || monitoring || '","time":' || time"""
    """ || ',"level":' || level || ',"values":[' || """
    + VALUES_TEXT_SQL
    + """ || ']}'"""
)

MESSAGES_SQL = f"""messages AS (
  SELECT 'CLLSEN-BRIDGE-HF-' || monitoring || '-PRO' AS topic,
         CAST(seq % 4 AS INT) AS "partition", seq AS "offset", {JSON_SQL} AS value
  FROM readings)"""

STORED_COLUMNS_SQL = (
    f'location, {SECOND_TEXT_SQL} AS seconds, {TIME_TEXT_SQL} AS time, rtime, "sensorType",'
    f' "dataType", monitoring, level, {VALUES_TEXT_SQL} AS "values"'
)


def stored_sql(table: str, floor_ms: int | None, source: str) -> str:
    """Stored rows of ``source``, a relation with the columns of a reading."""
    return (
        f"SELECT {table} AS table_name, {rowkey_sql(floor_ms)} AS rowkey, {STORED_COLUMNS_SQL}"
        f" FROM {source}"
    )


def newest_sql(rows: str, order: str = "time DESC, rtime DESC, seq DESC") -> str:
    """One row per table and row key of ``rows``, which has ``tab`` and ``rk``."""
    return f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY tab, rk ORDER BY {order}) = 1"


# --- inputs written once per session --------------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` has filled from the tables in ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = shared_folder(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def as_messages(df: DataFrame) -> DataFrame:
    """Readings as messages of six topics with four partitions each."""
    topic = F.concat(F.lit("CLLSEN-BRIDGE-HF-"), "monitoring", F.lit("-PRO"))
    return df.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*READING_COLUMNS)).cast("binary").alias("value"),
        topic.alias("topic"),
        (F.col("seq") % 4).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
    )


def message_folder(spark: SparkSession, sf_dir: str) -> str:
    """The readings as files of messages, one folder per topic."""

    def write(path: str) -> None:
        messages = as_messages(readings(spark, sf_dir))
        messages.hint("rebalance", "topic").write.partitionBy("topic").parquet(path)

    return written(spark, sf_dir, "messages", write)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(message_folder(spark, sf_dir))


# Topics of the messages, the last one for sensors that no monitoring name is mapped to.
TOPICS = [
    "CLLSEN-BRIDGE-HF-ACCE-PRO",
    "CLLSEN-BRIDGE-HF-DYNDEF-PRO",
    "CLLSEN-BRIDGE-HF-DISPMT-PRO",
    "CLLSEN-BRIDGE-HF-LOWSUMRY-PRO",
    "CLLSEN-BRIDGE-HF-STRAIN-PRO",
    "CLLSEN-BRIDGE-HF-UNMAPPED-PRO",
]

#: Number of the batch in which a reading arrives: the quarter of the month, but every seventh one
#: a batch later, and every 97th in the last batch.
BATCHES = 4
ARRIVAL_SQL = """least(3, CASE WHEN seq % 97 = 0 THEN 3
    ELSE greatest(0, least(3, (time {div} 86400000 - 19723) {div} 8)) + CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END END)"""

#: ``arrived``: the readings with their ``batch``.
ARRIVED_SQL = f"arrived AS (SELECT *, {ARRIVAL_SQL.format(div='//')} AS batch FROM readings)"


def arrived(df: DataFrame) -> DataFrame:
    return df.withColumn("batch", F.expr(ARRIVAL_SQL.format(div="div")))


#: Rows of a batch per file. A file is written and decoded by one task.
FILE_ROWS = 50_000


def batched_message_folder(spark: SparkSession, sf_dir: str) -> str:
    """The readings as messages in files by batch of arrival, in that order.

    All batches have as many files, see :func:`files_per_batch`.
    """

    def write(path: str) -> None:
        rows = arrived(readings(spark, sf_dir))
        largest = max((r["count"] for r in rows.groupBy("batch").count().collect()), default=0)
        files = max(1, ceil(largest / FILE_ROWS))
        for batch in range(BATCHES):
            some = as_messages(rows.where(F.col("batch") == batch))
            some.repartition(files).write.mode("append").parquet(path)
            # A task without rows may leave no file.
            for _ in range(_files(spark, path), files * (batch + 1)):
                some.limit(0).coalesce(1).write.mode("append").parquet(path)

    return written(spark, sf_dir, "batched-messages", write)


def _files(spark: SparkSession, path: str) -> int:
    return len(matching(spark, f"{path}/part-*"))


def files_per_batch(spark: SparkSession, path: str) -> int:
    """The number of files of each batch in a :func:`batched_message_folder`."""
    return _files(spark, path) // BATCHES


def batched_topic_stream(spark: SparkSession, topics: Sequence[str], sf_dir: str) -> DataFrame:
    """A stream of the readings as messages that gives one batch of arrival after the other."""
    path = batched_message_folder(spark, sf_dir)
    return topic_stream(spark, topics, "parquet", path=path, max_per_batch=files_per_batch(spark, path))


def day_table_folder(spark: SparkSession, sf_dir: str, odd: bool) -> str:
    """A table with one folder per day and the reading fields by position."""

    def write(path: str) -> None:
        rows = readings(spark, sf_dir).where(
            F.col("sensorType") == ("FLOW" if odd else "HPRESS")
        )
        fields = ["location", "terminal", "sensor", "rtime", "sensorType", "dataType", "monitoring"]
        table = rows.select(
            *[F.col(c).alias(f"c{i}") for i, c in enumerate(fields)],
            F.lit("").alias("c7"),
            F.col("time").alias("c8"),
            F.col("level").alias("c9"),
            F.col("values").alias("c10"),
            F.date_format(F.timestamp_millis("time"), "yyyyMMdd").alias("dt"),
        )
        table.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)

    return written(spark, sf_dir, "day-table-odd" if odd else "day-table-even", write)


def day_table(spark: SparkSession, sf_dir: str, odd: bool) -> DataFrame:
    path = day_table_folder(spark, sf_dir, odd)
    schema = "c0 string, c1 string, c2 string, c3 bigint, c4 string, c5 string, c6 string, "
    schema += "c7 string, c8 bigint, c9 int, c10 array<float>, dt string"
    return spark.read.schema(schema).parquet(path)


def day_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"flow": day_table(spark, sf_dir, True), "pressure": day_table(spark, sf_dir, False)}

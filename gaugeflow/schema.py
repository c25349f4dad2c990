"""The reading, the message that carries it, and the columns of a stored row."""

from __future__ import annotations

from pyspark.sql import types as T

READING = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("terminal", T.StringType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("rtime", T.LongType()),
        T.StructField("sensorType", T.StringType()),
        T.StructField("dataType", T.StringType()),
        T.StructField("monitoring", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ]
)

READING_COLUMNS = READING.fieldNames()

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

#: Columns that identify a sensor; together with a time bucket they form a group.
SENSOR_KEY = ["location", "terminal", "sensor"]

#: Readings of a group are ordered by these columns; ``seq`` is optional.
ORDER = ["time", "rtime", "seq"]

#: Columns of a stored row besides ``table_name`` and ``rowkey``.
STORED_COLUMNS = [
    "location",
    "seconds",
    "time",
    "rtime",
    "sensorType",
    "dataType",
    "monitoring",
    "level",
    "values",
]

#: The hourly flow table has no second-of-minute column.
FLOW_COLUMNS = [c for c in STORED_COLUMNS if c != "seconds"]

#: Where a stored row's message lay; rows of tables have null or ``seq`` alone.
POSITION = ["seq", "seq_partition", "seq_topic"]

#: A stored row. The flow table leaves ``seconds`` null.
STORED_ROW = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("rowkey", T.StringType()),
        *[
            READING[c] if c in ("location", "rtime", "sensorType", "dataType", "monitoring", "level")
            else T.StructField(c, T.StringType())
            for c in STORED_COLUMNS
        ],
        T.StructField("event_time", T.LongType()),
        T.StructField("key_day", T.DateType()),
        T.StructField("seq", T.LongType()),
        T.StructField("seq_partition", T.IntegerType()),
        T.StructField("seq_topic", T.StringType()),
    ]
)

SECOND_MS = 1_000
TEN_MINUTES_MS = 600_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

"""Scalar functions and filters, over all readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    PREFIX_SQL,
    SECOND_TEXT_SQL,
    TIME_TEXT_SQL,
    VALUES_TEXT_SQL,
    query,
    readings,
    rowkey_sql,
)
from gaugeflow import functions as G
from gaugeflow.operators import filters
from gaugeflow.schema import HOUR_MS, SECOND_MS, TEN_MINUTES_MS

FILTERED_SQL = (
    'SELECT location, terminal, sensor, rtime, "sensorType", "dataType", monitoring, time, level,'
    f' {VALUES_TEXT_SQL} AS "values", seq FROM readings WHERE '
)


def _shown(df):
    return df.withColumn("values", G.values_text("values"))


@query("filter_pv", FILTERED_SQL + "\"dataType\" = 'PV'")
def filter_pv(spark, sf_dir):
    return _shown(filters.point_values(readings(spark, sf_dir)))


@query("filter_s10m", FILTERED_SQL + "\"dataType\" = 'S10M'")
def filter_s10m(spark, sf_dir):
    return _shown(filters.features(readings(spark, sf_dir)))


@query("filter_hpress", FILTERED_SQL + "\"sensorType\" = 'HPRESS'")
def filter_hpress(spark, sf_dir):
    return _shown(filters.high_pressure(readings(spark, sf_dir)))


@query("filter_not_hpress", FILTERED_SQL + "\"sensorType\" <> 'HPRESS'")
def filter_not_hpress(spark, sf_dir):
    return _shown(filters.not_high_pressure(readings(spark, sf_dir)))


# The events have no sensor of type S10M, so the data type stands in for it here.
@query(
    "filter_feature_batch",
    'SELECT seq, "sensorType", sensor FROM'
    ' (SELECT * REPLACE ("dataType" AS "sensorType") FROM readings)'
    " WHERE \"sensorType\" = 'S10M'",
)
def filter_feature_batch(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("sensorType", F.col("dataType"))
    return filters.features(rows, "sensorType").select("seq", "sensorType", "sensor")


@query(
    "time_bucket",
    "SELECT seq, time//1000 AS b_1s, time//600000 AS b_10m, time//3600000 AS b_1h FROM readings",
)
def time_bucket(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "seq",
        G.time_bucket("time", SECOND_MS).alias("b_1s"),
        G.time_bucket("time", TEN_MINUTES_MS).alias("b_10m"),
        G.time_bucket("time", HOUR_MS).alias("b_1h"),
    )


@query(
    "group_key",
    "SELECT seq, location || '_' || terminal || '_' || sensor || '_' || (time//1000) AS group_key"
    " FROM readings",
)
def group_key(spark, sf_dir):
    key = G.group_key("location", "terminal", "sensor", "time", SECOND_MS)
    return readings(spark, sf_dir).select("seq", key.alias("group_key"))


@query("salt_prefix", f"SELECT seq, {PREFIX_SQL} AS prefix FROM readings")
def salt_prefix(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.salt_prefix("sensor", "terminal").alias("prefix"))


@query(
    "bucket_floor",
    "SELECT seq, time//1000*1000 AS f_1s, time//600000*600000 AS f_10m,"
    " time//3600000*3600000 AS f_1h FROM readings",
)
def bucket_floor(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "seq",
        G.bucket_floor("time", SECOND_MS).alias("f_1s"),
        G.bucket_floor("time", TEN_MINUTES_MS).alias("f_10m"),
        G.bucket_floor("time", HOUR_MS).alias("f_1h"),
    )


@query("reverse_time", "SELECT seq, 9223372036854775807 - time AS reversed FROM readings")
def reverse_time(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.reverse_time("time").alias("reversed"))


@query("rowkey_detail", f"SELECT seq, {rowkey_sql(None)} AS rowkey FROM readings")
def rowkey_detail(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.row_key("terminal", "sensor", "time").alias("rowkey"))


@query(
    "rowkey_sample",
    f"SELECT seq, {rowkey_sql(SECOND_MS)} AS k_1s, {rowkey_sql(TEN_MINUTES_MS)} AS k_10m,"
    f" {rowkey_sql(HOUR_MS)} AS k_1h FROM readings",
)
def rowkey_sample(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "seq",
        G.row_key("terminal", "sensor", "time", SECOND_MS).alias("k_1s"),
        G.row_key("terminal", "sensor", "time", TEN_MINUTES_MS).alias("k_10m"),
        G.row_key("terminal", "sensor", "time", HOUR_MS).alias("k_1h"),
    )


@query("time_text", f"SELECT seq, {TIME_TEXT_SQL} AS time_text FROM readings")
def time_text(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.time_text("time").alias("time_text"))


@query("second_text", f"SELECT seq, {SECOND_TEXT_SQL} AS seconds FROM readings")
def second_text(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.second_text("time").alias("seconds"))


@query("values_text", f"SELECT seq, {VALUES_TEXT_SQL} AS values_text FROM readings")
def values_text(spark, sf_dir):
    return readings(spark, sf_dir).select("seq", G.values_text("values").alias("values_text"))


# Bytes are compared as hex digits.
@query(
    "cell_bytes",
    "SELECT seq, hex(sensor) AS sensor, lpad(hex(rtime), 16, '0') AS rtime,"
    " lpad(hex(level), 8, '0') AS level FROM readings",
)
def cell_bytes(spark, sf_dir):
    cells = G.cell_map({"sensor": "string", "rtime": "bigint", "level": "int"})
    return (
        readings(spark, sf_dir)
        .select("seq", cells.alias("cells"))
        .select("seq", *[F.hex(F.col("cells")[c]).alias(c) for c in ("sensor", "rtime", "level")])
    )


@query("first_channel", 'SELECT seq, CAST("values"[1] AS DOUBLE) AS v FROM readings')
def first_channel(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "seq", G.first_channel("values").cast("double").alias("v")
    )


@query(
    "float_mean",
    "SELECT sensor, CAST(CAST(sum(CAST(\"values\"[1] AS DOUBLE)) / count(*) AS FLOAT) AS DOUBLE)"
    " AS mean FROM readings GROUP BY sensor",
)
def float_mean(spark, sf_dir):
    mean = G.float_mean(G.first_channel("values")).cast("double")
    return readings(spark, sf_dir).groupBy("sensor").agg(mean.alias("mean"))


@query(
    "float_array",
    "SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS first,"
    " CAST(CAST(value / 3 AS FLOAT) AS DOUBLE) AS second FROM events",
)
def float_array(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    floats = G.as_floats(F.array(F.col("value"), F.col("value") / 3))
    return events.select("event_id", floats.alias("v")).select(
        "event_id",
        F.col("v")[0].cast("double").alias("first"),
        F.col("v")[1].cast("double").alias("second"),
    )


@query(
    "day_range",
    "SELECT strftime(make_timestamp_ms(time), '%Y%m%d') AS dt,"
    " strftime(make_timestamp_ms(time + 86400000), '%Y%m%d') AS next_dt, count(*) AS n"
    " FROM readings GROUP BY ALL",
)
def day_range(spark, sf_dir):
    ts = F.timestamp_millis("time")
    return (
        readings(spark, sf_dir)
        .groupBy(
            G.day_text(ts).alias("dt"),
            G.day_text(F.date_add(ts.cast("date"), 1)).alias("next_dt"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )

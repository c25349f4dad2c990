"""Samplers, over all readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DAY, GROUP_SQL, mixed_readings, query, readings
from gaugeflow.functions import row_key
from gaugeflow.operators import filters, sampling
from gaugeflow.schema import SECOND_MS, TEN_MINUTES_MS
from gaugeflow.session import write_out

GROUP = ["location", "terminal", "sensor", "bucket"]


def bucketed_sql(bucket_ms: int, where: str = "TRUE", source: str = "readings") -> str:
    return f"b AS (SELECT *, time//{bucket_ms} AS bucket FROM {source} WHERE {where})"


def last_pair_sql(bucket_ms: int, where: str = "TRUE", source: str = "readings") -> str:
    """``rep``: the representative row of each group by its last two readings."""
    return f"""{bucketed_sql(bucket_ms, where, source)},
      ranked AS (SELECT *, row_number() OVER (PARTITION BY {GROUP_SQL}
                   ORDER BY time DESC, rtime DESC, seq DESC) AS rn FROM b),
      rep AS (SELECT * FROM ranked WHERE rn <= 2
              QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL} ORDER BY level DESC, rn) = 1)"""


HEAD_SQL = f"""head AS (SELECT {GROUP_SQL}, max("values"[1])::DOUBLE AS v_max,
        min("values"[1])::DOUBLE AS v_min,
        (sum("values"[1]::DOUBLE) / count(*))::FLOAT::DOUBLE AS v_mean
      FROM b GROUP BY ALL)"""

MIXED_SQL = """mixed AS (SELECT * REPLACE (CASE WHEN "sensorType" = 'FLOW' THEN "values"[1:1]
    ELSE "values" END AS "values") FROM readings)"""


def _three(df):
    parts = [F.col("values")[i].cast("double") for i in range(3)]
    return df.select(
        *GROUP, "seq", "level", *[p.alias(n) for p, n in zip(parts, ("v_max", "v_min", "v_mean"))]
    )


@query(
    "earliest_per_bucket",
    f", {bucketed_sql(DAY)} SELECT {GROUP_SQL}, seq, time, rtime, level, CAST(\"values\"[2] AS"
    f" DOUBLE) AS v2 FROM b QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL}"
    " ORDER BY time, rtime, seq) = 1",
)
def earliest_per_bucket(spark, sf_dir):
    rows = sampling.earliest(readings(spark, sf_dir), DAY)
    second = F.col("values")[1].cast("double")
    return rows.select(*GROUP, "seq", "time", "rtime", "level", second.alias("v2"))


@query(
    "earliest_per_second",
    f", {bucketed_sql(SECOND_MS)} SELECT {GROUP_SQL}, seq, time FROM b"
    f" QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) = 1",
)
def earliest_per_second(spark, sf_dir):
    return sampling.earliest(readings(spark, sf_dir), SECOND_MS).select(*GROUP, "seq", "time")


def head_stats_sql(bucket_ms: int, extra: str = "") -> str:
    pv = "\"dataType\" = 'PV'"
    return (
        f", {last_pair_sql(bucket_ms, pv)}, {HEAD_SQL} SELECT {GROUP_SQL}, seq, level, v_max, v_min,"
        f" v_mean{extra} FROM rep JOIN head USING ({GROUP_SQL})"
    )


@query("head_stats", head_stats_sql(DAY))
def head_stats(spark, sf_dir):
    """One-day buckets, so that groups have several readings."""
    return _three(sampling.head_stats(filters.point_values(readings(spark, sf_dir)), DAY))


@query("head_stats_10m", head_stats_sql(TEN_MINUTES_MS))
def head_stats_10m(spark, sf_dir):
    rows = filters.point_values(readings(spark, sf_dir))
    return _three(sampling.head_stats(rows, TEN_MINUTES_MS))


@query(
    "head_stats_keyed",
    head_stats_sql(
        DAY,
        ", substr(md5(sensor || terminal), 1, 6) || ':' || terminal || ':' || sensor || ':' ||"
        f" (9223372036854775807 - time//{DAY}*{DAY}) AS rowkey",
    ),
)
def head_stats_keyed(spark, sf_dir):
    """The core of the bridge job: point values, first-channel statistics, row key."""
    rows = sampling.head_stats(filters.point_values(readings(spark, sf_dir)), DAY)
    key = row_key("terminal", "sensor", "time", DAY).alias("rowkey")
    return rows.select(
        *GROUP,
        "seq",
        "level",
        *[F.col("values")[i].cast("double").alias(n) for i, n in enumerate(("v_max", "v_min", "v_mean"))],
        key,
    )


MAX_LEVEL_SQL = f"""{bucketed_sql(DAY)}, rep AS (SELECT * FROM b
    QUALIFY row_number() OVER (PARTITION BY {GROUP_SQL}
      ORDER BY level DESC, time DESC, rtime DESC, seq DESC) = 1)"""


@query(
    "head_stats_max_level",
    f", {MAX_LEVEL_SQL}, {HEAD_SQL} SELECT {GROUP_SQL}, seq, level, v_max, v_min, v_mean"
    f" FROM rep JOIN head USING ({GROUP_SQL})",
)
def head_stats_max_level(spark, sf_dir):
    return _three(sampling.head_stats(readings(spark, sf_dir), DAY, mode=sampling.MAX_LEVEL))


CHANNELS_SQL = f"""ch AS (SELECT {GROUP_SQL}, i AS channel, max("values"[i])::DOUBLE AS v_max,
        min("values"[i])::DOUBLE AS v_min,
        (sum("values"[i]::DOUBLE) / count(*))::FLOAT::DOUBLE AS v_mean
      FROM (SELECT *, unnest(range(1, len("values") + 1)) AS i FROM b) GROUP BY ALL)"""


def per_channel(df, keys):
    """``[max, min, mean, max, ...]`` as one row per channel."""
    triples = F.transform(
        F.sequence(F.lit(0), (F.size("values") / 3).cast("int") - 1),
        lambda i: F.struct(
            (i + 1).cast("bigint").alias("channel"),
            F.get("values", i * 3).cast("double").alias("v_max"),
            F.get("values", i * 3 + 1).cast("double").alias("v_min"),
            F.get("values", i * 3 + 2).cast("double").alias("v_mean"),
        ),
    )
    return df.select(*keys, F.inline(triples))


@query(
    "channel_stats",
    f", {last_pair_sql(DAY)}, {CHANNELS_SQL} SELECT {GROUP_SQL}, seq, level, channel, v_max, v_min,"
    f" v_mean FROM rep JOIN ch USING ({GROUP_SQL})",
)
def channel_stats(spark, sf_dir):
    rows = sampling.channel_stats(readings(spark, sf_dir), DAY)
    return per_channel(rows, [*GROUP, "seq", "level"])


@query(
    "channel_stats_wide",
    """SELECT label, max(seq) AS seq, i AS channel, max(e[i])::DOUBLE AS v_max,
       min(e[i])::DOUBLE AS v_min, (sum(e[i]::DOUBLE) / count(*))::FLOAT::DOUBLE AS v_mean FROM
       (SELECT label, embedding AS e, max(vec_id) OVER (PARTITION BY label) AS seq,
               unnest(range(1, len(embedding) + 1)) AS i
        FROM embeddings) GROUP BY label, i""",
)
def channel_stats_wide(spark, sf_dir):
    """64 channels per row; the label is the sensor and the id is the time."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = vectors.select(
        F.lit("L").alias("location"),
        F.lit("T").alias("terminal"),
        F.col("label").cast("string").alias("sensor"),
        F.col("vec_id").alias("rtime"),
        F.lit(0).cast("bigint").alias("time"),
        F.lit(0).alias("level"),
        F.col("embedding").alias("values"),
        F.col("vec_id").alias("seq"),
    )
    out = per_channel(sampling.channel_stats(rows, DAY), ["sensor", "seq"])
    return out.withColumn("label", F.col("sensor").cast("int")).drop("sensor")


@query(
    "conditional_stats",
    f", {MIXED_SQL}, {last_pair_sql(DAY, source='mixed')}, {HEAD_SQL}"
    f" SELECT {GROUP_SQL}, seq, level, CAST(if(len(\"values\") = 1, 3, len(\"values\")) AS INT) AS n_values,"
    ' if(len("values") = 1, v_max, "values"[1]::DOUBLE) AS v1,'
    ' if(len("values") = 1, v_min, "values"[2]::DOUBLE) AS v2,'
    ' if(len("values") = 1, v_mean, NULL) AS v3'
    f" FROM rep JOIN head USING ({GROUP_SQL})",
)
def conditional_stats(spark, sf_dir):
    rows = sampling.conditional_stats(mixed_readings(spark, sf_dir), DAY)
    return rows.select(
        *GROUP,
        "seq",
        "level",
        F.size("values").alias("n_values"),
        *[F.get("values", F.lit(i)).cast("double").alias(f"v{i + 1}") for i in range(3)],
    )


@query(
    "representative_last_pair",
    f", {last_pair_sql(DAY)} SELECT {GROUP_SQL}, seq, level, time FROM rep",
)
def representative_last_pair(spark, sf_dir):
    rows = sampling.representative(readings(spark, sf_dir), DAY)
    return rows.select(*GROUP, "seq", "level", "time")


@query(
    "representative_max_level",
    f", {MAX_LEVEL_SQL} SELECT {GROUP_SQL}, seq, level, time FROM rep",
)
def representative_max_level(spark, sf_dir):
    rows = sampling.representative(readings(spark, sf_dir), DAY, sampling.MAX_LEVEL)
    return rows.select(*GROUP, "seq", "level", "time")


@query(
    "merged_states",
    f", {last_pair_sql(10 * DAY)}, {HEAD_SQL} SELECT {GROUP_SQL}, seq, level, v_max, v_min, v_mean"
    f" FROM rep JOIN head USING ({GROUP_SQL})",
)
def merged_states(spark, sf_dir):
    """Ten-day rows merged from the states of one-day buckets."""
    days = write_out(sampling.sample_state(readings(spark, sf_dir), DAY), "state")
    return _three(sampling.head_from_state(sampling.merge_states(days, 10)))


@query(
    "group_list",
    f", {bucketed_sql(DAY)} SELECT {GROUP_SQL}, seq, time, CAST(row_number() OVER"
    f" (PARTITION BY {GROUP_SQL} ORDER BY time, rtime, seq) AS BIGINT) AS position FROM b",
)
def group_list(spark, sf_dir):
    """The list of each group's readings, one row per reading with its position."""
    return sampling.group_list(readings(spark, sf_dir), DAY).select(*GROUP, "seq", "time", "position")

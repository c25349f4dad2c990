from __future__ import annotations

import json

import pytest
from gaugeflow.schema import MESSAGE, READING_COLUMNS
from gaugeflow.sinks.messages import message_rows
from gaugeflow.sources import messages as M
from gaugeflow.sources import tables
from gaugeflow.sources.tables import day_bounds
from pyspark.sql import functions as F

from helpers import frame, reading


def as_messages(spark, values):
    rows = [(None, bytearray(v.encode()), "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE)


def test_a_reading_survives_the_message(spark):
    rows = [
        reading(0, values=[1.5, float("nan"), -0.1, 1e10], sensor="传感器"),
        reading(1, values=[], level=-3, time=-5),
    ]
    sent = message_rows(frame(spark, rows), "topic").select(F.col("value").cast("string"))
    back = M.decode_json(as_messages(spark, [r[0] for r in sent.collect()])).orderBy("seq")
    for expected, got in zip(rows, back.collect()):
        for name in READING_COLUMNS:
            assert str(got[name]) == str(
                frame(spark, [expected]).first()[name]
            ), name


def test_malformed_message_stops_the_job(spark):
    with pytest.raises(Exception, match="MALFORMED|malformed|PARSE"):
        M.decode_json(as_messages(spark, ["{oops"])).collect()


def test_incomplete_message_stops_the_job(spark):
    lacking = json.dumps({k: v for k, v in reading(0).items() if k not in ("seq", "monitoring")})
    with pytest.raises(Exception, match="reading without monitoring"):
        M.decode_json(as_messages(spark, [lacking])).collect()


def test_lenient_decoding_keeps_broken_messages(spark):
    good = json.dumps({**reading(0), "seq": None})
    lacking = json.dumps({k: v for k, v in reading(0).items() if k not in ("seq", "sensor")})
    rows = M.decode_json_lenient(as_messages(spark, [good, "{oops", lacking])).orderBy("seq").collect()
    assert [r["broken"] for r in rows] == [None, "{oops", lacking]
    assert rows[0]["sensor"] == "S1"


@pytest.fixture(scope="module")
def day_tables(spark, tmp_path_factory):
    """Two tables, three days each; columns are read by position."""
    out = {}
    for name, value in (("one", 1.0), ("two", 2.0)):
        path = str(tmp_path_factory.mktemp(name) / "table")
        rows = [
            ("L1", "T1", "S1", 5, "ST", "PV", "ACCE", "unused", 1000 * day, day, [value, None], f"2017110{day}")
            for day in (1, 2, 3)
        ]
        schema = (
            "a string, b string, c string, d bigint, e string, f string, g string, h string,"
            " i bigint, j int, `k.l` array<float>, dt string"
        )
        spark.createDataFrame(rows, schema).write.partitionBy("dt").parquet(path)
        out[name] = spark.read.schema(schema).parquet(path)
    return out


def test_one_day(spark, day_tables):
    (row,) = tables.one_day(day_tables["one"], "20171102").collect()
    assert (row["rtime"], row["time"], row["level"], row["values"]) == (5, 2000, 2, [1.0, None])
    assert tables.one_day(day_tables["one"], "20171109").count() == 0


def test_range_includes_both_ends_of_every_table(day_tables):
    rows = tables.tables_and_days(day_tables, "20171101", "20171102").collect()
    assert sorted((r["source_table"], r["dt"]) for r in rows) == [
        (t, d) for t in ("one", "two") for d in ("20171101", "20171102")
    ]


def test_days_prune_partitions(spark, day_tables):
    plan = tables.one_day(day_tables["one"], "20171102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan


def test_day_bounds():
    assert day_bounds("20170101", "20170102") == ("20170101", "20170102")
    first, last = day_bounds("20170101", None)
    assert first == last and len(first) == 8

from __future__ import annotations

import hashlib
from datetime import date

import pytest
from gaugeflow import functions as G
from pyspark.sql import functions as F

from helpers import BASE_TIME, four, frame, reading

MAX = 2**63 - 1


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_row_keys_of_the_hand_made_rows(spark):
    df = frame(spark, four()[3:])
    assert one(df, G.row_key("terminal", "sensor", "time", 1000)) == "4c9252:T1:S1:9223370530866020807"
    assert one(df, G.row_key("terminal", "sensor", "time")) == "4c9252:T1:S1:9223370530866019907"
    assert one(df, G.salt_prefix("sensor", "terminal")) == hashlib.md5(b"S1T1").hexdigest()[:6]
    assert one(df, G.reverse_time("time")) == MAX - BASE_TIME - 900
    assert one(df, G.group_key("location", "terminal", "sensor", "time", 1000)) == "L1_T1_S1_1505988755"


def test_texts(spark):
    df = frame(spark, four()[3:])
    assert one(df, G.time_text("time")) == "2017-09-21 10:12:35:900"
    assert one(df, G.second_text("time")) == "35"
    assert one(df, G.values_text("values")) == "0.5,30.0"


def test_texts_follow_the_session_zone(spark):
    df = frame(spark, four()[3:])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(df, G.time_text("time")) == "2017-09-21 18:12:35:900"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_values_text_of_special_values(spark):
    rows = [reading(1, values=[1e10, None, float("nan"), -0.0]), reading(2, values=[])]
    texts = [r[0] for r in frame(spark, rows).orderBy("seq").select(G.values_text("values")).collect()]
    assert texts == ["1.0E10,null,NaN,-0.0", ""]


@pytest.mark.parametrize("time,bucket", [(-1500, -1), (-999, 0), (0, 0), (999, 0), (1000, 1)])
def test_bucket_truncates_towards_zero(spark, time, bucket):
    df = frame(spark, [reading(1, time=time)])
    assert one(df, G.time_bucket("time", 1000)) == bucket
    assert one(df, G.bucket_floor("time", 1000)) == bucket * 1000


@pytest.mark.parametrize("value", [0, 1, -1, 255, -(2**31), 2**31 - 1])
def test_int_cells(spark, value):
    df = frame(spark, [reading(1, level=value, rtime=value * 2**20)])
    assert bytes(one(df, G.int_cell("level"))) == value.to_bytes(4, "big", signed=True)
    assert bytes(one(df, G.long_cell("rtime"))) == (value * 2**20).to_bytes(8, "big", signed=True)


def test_text_cells_and_map(spark):
    df = frame(spark, [reading(1, location="合肥", level=-2)])
    cells = one(df, G.cell_map({"location": "string", "rtime": "bigint", "level": "int"}))
    assert bytes(cells["location"]) == "合肥".encode()
    assert bytes(cells["level"]) == b"\xff\xff\xff\xfe"
    assert bytes(cells["rtime"]) == bytes(8)


def test_first_channel(spark):
    df = frame(spark, [reading(1, values=[])])
    assert one(df, G.first_channel("values", on_empty="null")) is None
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        one(df, G.first_channel("values"))


def test_mean_is_summed_in_double(spark):
    values = [16777216.0, 1.0, 1.0]
    df = frame(spark, [reading(i, values=[v]) for i, v in enumerate(values)])
    mean = df.agg(G.float_mean(F.col("values")[0]).alias("m")).first()["m"]
    assert mean == pytest.approx(16777218.0 / 3, rel=1e-7)


def test_days():
    assert G.days_between(date(2017, 9, 29), date(2017, 10, 2)) == [
        "20170929",
        "20170930",
        "20171001",
        "20171002",
    ]
    assert G.days_between(date(2017, 9, 29), date(2017, 9, 28)) == []

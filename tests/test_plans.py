"""The physical plans that the design relies on."""

from __future__ import annotations

import re
from datetime import date

import pytest
from gaugeflow.operators import filters, sampling
from gaugeflow.operators.lookup import topic_map, with_topic
from gaugeflow.operators.routing import stored_rows
from gaugeflow.schema import MESSAGE
from gaugeflow.session import shared_folder
from gaugeflow.sinks.changes import current, write_changes
from gaugeflow.sources.messages import decode_json
from gaugeflow.sources.tables import tables_and_days
from pyspark.sql import functions as F

import helpers as H
from helpers import frame, four


@pytest.fixture(scope="module")
def table(spark):
    path = shared_folder(spark, "plans")
    frame(spark, four()).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(path)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, node):
    return len(re.findall(rf"\b{node}\b", text))


def test_filters_and_columns_reach_the_scan(table):
    text = plan(filters.point_values(table).select("sensor", "time"))
    assert "EqualTo(dataType,PV)" in text
    assert "ReadSchema: struct<sensor:string,dataType:string,time:bigint>" in text


def test_earliest_combines_before_its_only_shuffle(table):
    text = plan(sampling.earliest(table, 1000))
    assert count(text, "Exchange") == 1
    assert "partial_min" in text


def test_last_pair_limits_groups_before_the_shuffle(table):
    text = plan(sampling.representative(table, 1000))
    assert count(text, "Exchange") == 1
    assert "row_number(), 2, Partial" in text and "row_number(), 2, Final" in text


def test_head_stats_shuffle_each_branch_once_and_join_in_place(table):
    text = plan(sampling.head_stats(filters.point_values(table), 1000))
    assert count(text, "Exchange") == 2
    assert count(text, "SortMergeJoin") == 1
    assert "row_number(), 2, Partial" in text and "partial_max" in text


def test_head_stats_read_the_values_in_one_branch_only(table):
    scans = re.findall(r"FileScan parquet \[(.*?)\]", plan(sampling.head_stats(table, 1000)))
    columns = [{c.split("#")[0] for c in scan.split(",")} for scan in scans]
    assert len(columns) == 2
    (narrow,) = [c for c in columns if "values" in c]
    assert narrow == {"location", "terminal", "sensor", "time", "values"}


def test_max_level_stats_take_one_scan(table):
    text = plan(sampling.head_stats(table, 1000, sampling.MAX_LEVEL))
    assert count(text, "FileScan") == 1 and count(text, "Exchange") == 1


def test_channels_are_combined_before_the_shuffle(table):
    text = plan(sampling.channel_stats(table, 1000))
    assert "partial_max(v" in text and "partial_collect_list" in text
    assert count(text, "Exchange") == 3


def test_topics_are_broadcast(table, spark):
    text = plan(with_topic(table, topic_map()))
    assert "BroadcastHashJoin" in text and "Exchange hash" not in text


def test_no_python_in_any_operator(table):
    for df in (
        sampling.earliest(table, 1000),
        sampling.head_stats(table, 1000),
        sampling.channel_stats(table, 1000),
        sampling.conditional_stats(table, 1000),
        stored_rows(table, "T", 1000),
    ):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)


def test_one_large_table_is_written_by_many_tasks(spark, tmp_path):
    """Almost all rows belong to one table."""
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        rows = frame(spark, [H.reading(i, sensor=f"S{i}") for i in range(20000)], 8)
        write_changes(stored_rows(rows, "T", None), str(tmp_path), 0)
    finally:
        for name in names:
            spark.conf.unset(name)
    files = spark.read.parquet(str(tmp_path / "changes")).inputFiles()
    assert len(files) > 1


def test_a_large_table_is_also_split_without_adaptive_execution(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = frame(spark, [H.reading(i, time=H.BASE_TIME + i) for i in range(2000)], 8)
        write_changes(stored_rows(rows, "T", None), str(tmp_path), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spark.read.parquet(str(tmp_path / "changes")).inputFiles()) == 4


def test_current_rows_take_one_shuffle_over_the_days_asked_for(spark, tmp_path):
    root = str(tmp_path)
    day = 86_400_000
    old = [H.reading(i, time=H.BASE_TIME + i * day) for i in range(5)]
    write_changes(stored_rows(frame(spark, old), "T", None), root, 0)
    write_changes(stored_rows(frame(spark, [H.reading(9)]), "T", None), root, 1)
    assert plan(current(spark, root)).count("Exchange hashpartitioning") == 1
    assert sorted(r["seq"] for r in current(spark, root).collect()) == [1, 2, 3, 4, 9]
    df = current(spark, root, tables=["T"], days=[date(2017, 9, 21)])
    assert all("key_day=2017-09-21" in f for f in df.inputFiles())
    (row,) = df.collect()
    assert row["seq"] == 9


def test_backfill_features_are_filtered_in_the_scan(table, spark):
    day_table = table.select(
        *table.columns[:7], F.lit("").alias("x"), *table.columns[7:10], F.lit("20170921").alias("dt")
    )
    path = shared_folder(spark, "day-table")
    day_table.write.partitionBy("dt").parquet(path)
    rows = tables_and_days({"t": spark.read.parquet(path)}, "20170920", "20170922")
    assert "EqualTo(sensorType,S10M)" in plan(filters.features(rows, "sensorType"))


def test_messages_are_decoded_once(spark):
    """Filters on fields stay above the decoding, also several of them."""
    messages = spark.createDataFrame([], MESSAGE)
    messages.write.parquet(path := shared_folder(spark, "messages"))
    rows = decode_json(spark.read.schema(MESSAGE).parquet(path))
    for name in ("all", "point_values", "high_pressure"):
        some = filters.FILTERS[name](rows).where("level > 1")
        assert count(plan(some), "from_json") == 1
    assert count(plan(sampling.head_stats(filters.point_values(rows), 1000)), "from_json") == 2  # two branches


def test_one_exploded_row_per_channel(spark):
    rows, keys, _ = sampling.grouped_rows(frame(spark, [*four(), H.reading(7, values=[])]), 1000, ())
    assert sampling.exploded_channels(rows, keys).count() == 4 * 2 + 1

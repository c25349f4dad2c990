from __future__ import annotations

import os
import signal
import threading
import time

import pytest
from gaugeflow import __main__ as command
from gaugeflow.functions import values_text
from gaugeflow.operators import sampling
from gaugeflow.plans.backfill import PER_DAY, bridge_backfill, earliest_backfill, run_backfill
from gaugeflow.plans.jobs import JOBS
from gaugeflow.plans.settings import configured, consumer_options, load_properties
from gaugeflow.sinks.changes import changes, current
from gaugeflow.sources.tables import named_tables, tables_and_days
from gaugeflow.streaming.partials import late_readings
from pyspark.sql import functions as F

import helpers as H
from helpers import BASE_TIME, frame, reading
from test_streaming import Topic

DAYS = ("20170920", "20170922")
DAY = 86_400_000


def test_job_list():
    assert set(JOBS) == {
        "bridge_1s",
        "bridge_10m",
        "bridge_detail",
        "gas_1s",
        "drain_1s",
        "heat_1s",
        "water_1s",
        "water_flow",
    }
    assert {n: j.interval_s for n, j in JOBS.items() if j.interval_s != 10} == {
        "bridge_1s": 20,
        "bridge_10m": 600,
        "bridge_detail": 20,
        "gas_1s": 20,
        "water_flow": 600,
    }


def write_properties(tmp_path, **settings):
    path = tmp_path / "job.properties"
    lines = [f"{k.replace('__', '.')}={v}" for k, v in settings.items()]
    path.write_text("# a comment\n\n" + "\n".join(lines) + "\n")
    return str(path)


def test_settings(tmp_path):
    path = write_properties(
        tmp_path,
        spark__interval=5,
        kafka__topic="a,b",
        hbase__tables="GAS_1S,GasDetail",
        acce="X,Y",
        kafka__broker__list="b:1",
        kafka__groupid="g",
        auto__offset__reset="smallest",
    )
    settings = load_properties(path)
    spec = configured(JOBS["gas_1s"], settings)
    assert (spec.interval_s, spec.topics) == (5, ("a", "b"))
    assert [o.table for o in spec.outputs] == ["GAS_1S", "GasDetail"]
    assert spec.topic_by_monitoring["Y"].endswith("ACCE-HIVE")
    assert consumer_options(settings) == {
        "kafka.bootstrap.servers": "b:1",
        "kafka.group.id": "g",
        "startingOffsets": "earliest",
    }
    positions = '{"A": {"0": 5}}'
    assert consumer_options({**settings, "auto.offset.reset": positions})["startingOffsets"] == positions
    water = configured(JOBS["water_1s"], {"hbase.tables": "WATER_1S,WaterDetail"})
    assert [o.table for o in water.outputs] == ["WATER_1S", "WATER_1S", "WaterDetail"]
    bridge = configured(JOBS["bridge_1s"], {})
    assert bridge.outputs == JOBS["bridge_1s"].outputs
    tuned = {"sample.mode": "max_level", "sample.onRagged": "skip", "legacyNames": "true"}
    detail, sample = configured(JOBS["bridge_1s"], tuned).outputs
    assert sample.options == {"mode": "max_level"} and detail.table is not JOBS["bridge_1s"].outputs[0].table
    assert configured(JOBS["water_1s"], tuned).outputs[0].options == {
        "mode": "max_level",
        "on_ragged": "skip",
    }


def test_command_runs_a_job(spark, tmp_path):
    Topic(spark, tmp_path / "in").send(H.four())
    path = write_properties(
        tmp_path,
        kafka__topic="t",
        input__format="parquet",
        input__path=tmp_path / "in",
        input__encoding="json",
        output__format="parquet",
        output__path=tmp_path / "out",
        spark__checkpointPath=tmp_path / "positions",
        once="true",
    )
    command.main(["bridge_1s", path])
    rows = current(spark, str(tmp_path / "out"), tables=["BRIDGE_T1_1S"]).collect()
    assert [r["values"] for r in rows] == ["4.0,0.5,2.0"]


def test_new_checkpoint_on_an_old_store_keeps_its_rows(spark, tmp_path):
    for i, rows in enumerate((H.four()[:2], H.four()[2:])):
        Topic(spark, tmp_path / f"in{i}").send(rows)
        path = write_properties(
            tmp_path,
            kafka__topic="t",
            input__format="parquet",
            input__path=tmp_path / f"in{i}",
            input__encoding="json",
            output__format="parquet",
            output__path=tmp_path / "out",
            spark__checkpointPath=tmp_path / f"positions{i}",
            once="true",
        )
        command.main(["heat_1s", path])
    assert current(spark, str(tmp_path / "out"), tables=["HEAT"]).count() == 4


def test_command_refuses_unknown_jobs_and_missing_settings(spark, tmp_path):
    with pytest.raises(SystemExit, match="usage"):
        command.main(["nothing", "x"])
    with pytest.raises(SystemExit, match="missing settings: output.path"):
        command.main(["gas_1s", write_properties(tmp_path)])


def day_table(spark, path, rows):
    df = frame(spark, rows)
    columns = [c for c in df.columns if c != "seq"]
    out = df.select(
        *columns[:7],
        F.lit("").alias("unused"),
        *columns[7:],
        F.date_format(F.timestamp_millis("time"), "yyyyMMdd").alias("dt"),
    )
    out.write.partitionBy("dt").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    def rows(first, sensor_type):
        return [
            reading(
                first + i,
                sensor=f"S{i % 3}",
                time=BASE_TIME + (i % 4 - 1) * DAY + i * 130,
                level=i % 4,
                sensorType=sensor_type,
                values=[float(i)] if i % 3 else [float(i), 1.0],
            )
            for i in range(60)
        ]

    made = {"one": rows(0, "HPRESS"), "two": rows(100, "S10M")}
    root = tmp_path_factory.mktemp("days")
    frames = {n: day_table(spark, str(root / n), r) for n, r in made.items()}
    return made, frames


def test_bridge_backfill(spark, tables):
    made, frames = tables
    rows = bridge_backfill(frames, *DAYS)
    counts = {r["table_name"]: r["count"] for r in rows.groupBy("table_name").count().collect()}
    # One row in four is from the day after the range.
    kept = {name: [r for r in rs if r["seq"] % 4 != 3] for name, rs in made.items()}
    assert counts["BRIDGE_FEATURE_10M"] == len(kept["two"])
    for table, bucket in (("BRIDGE_T1_1S", 1000), ("BRIDGE_TENDENCY_10M", 600_000)):
        expected = {}
        for rs in kept.values():
            rows_of = {r["seq"]: r for r in rs}
            for seq, values in H.conditional_stats(rs, bucket).values():
                expected[rows_of[seq]["sensorType"], rows_of[seq]["time"]] = values
        got = {
            (r["sensorType"], r["event_time"]): [float(v) for v in r["values"].split(",")]
            for r in rows.where(F.col("table_name") == table).collect()
        }
        assert counts[table] == len(got) == len(expected)
        for key, values in expected.items():
            assert got[key] == pytest.approx(values, rel=1e-6)


def test_coarse_rows_equal_direct_sampling(spark, tables):
    _, frames = tables
    readings = tables_and_days(frames, *DAYS)
    direct = sampling.conditional_stats(readings, 600_000, PER_DAY)
    merged = bridge_backfill(frames, *DAYS).where("table_name = 'BRIDGE_TENDENCY_10M'")
    assert sorted(
        (r["event_time"], r["values"], r["sensorType"]) for r in merged.collect()
    ) == sorted(
        (r["time"], r["v"], r["sensorType"])
        for r in direct.select("time", values_text("values").alias("v"), "sensorType").collect()
    )


def test_backfill_keys_are_exact_unless_asked(tables):
    _, frames = tables
    exact = earliest_backfill(frames, *DAYS, "GAS_1S").first()
    assert int(exact["rowkey"].split(":")[-1]) == 2**63 - 1 - exact["event_time"]
    floored = earliest_backfill(frames, *DAYS, "GAS_1S", floor_key=True).first()
    assert int(floored["rowkey"].split(":")[-1]) == 2**63 - 1 - floored["event_time"] // 1000 * 1000


def test_all_tables_are_backfilled(spark, tables, tmp_path):
    _, frames = tables
    rows = earliest_backfill(frames, *DAYS, "GAS_1S")
    assert {r["sensorType"] for r in rows.select("sensorType").distinct().collect()} == {"HPRESS", "S10M"}
    for _ in range(2):
        run_backfill(rows, str(tmp_path))
    assert changes(spark, str(tmp_path)).count() == 2 * rows.count()
    # Both tables have readings of the same sensors and times.
    assert current(spark, str(tmp_path)).count() == rows.select("rowkey").distinct().count()


def test_uneven_buckets_are_refused(tables):
    with pytest.raises(ValueError, match="multiple"):
        bridge_backfill(tables[1], *DAYS, fine_ms=7000)


def test_command_backfills(spark, tables, tmp_path, capsys):
    _, frames = tables
    frames["one"].createOrReplaceTempView("one")
    settings = dict(hiveTable="one", startDay=DAYS[0], endDay=DAYS[1], output__path=tmp_path / "out")
    command.main(["bridge_backfill", write_properties(tmp_path, **settings)])
    assert "one dt=20170921\n" in capsys.readouterr().out
    assert not (tmp_path / "out").exists()
    command.main(["bridge_backfill", write_properties(tmp_path, isTest="False", **settings)])
    assert current(spark, str(tmp_path / "out")).count() > 0
    command.main(["gaswater_backfill", write_properties(tmp_path, hbaseTable="G", **settings)])
    assert current(spark, str(tmp_path / "out"), tables=["G"]).count() > 0


def test_command_copies(spark, tmp_path):
    Topic(spark, tmp_path / "in").send(H.four())
    path = write_properties(
        tmp_path,
        kafka__topic="t",
        sendTopic="copy",
        input__format="parquet",
        input__path=tmp_path / "in",
        output__path=tmp_path / "out",
        spark__checkpointPath=tmp_path / "positions",
        once="true",
    )
    command.main(["topic_copy", path])
    assert spark.read.parquet(str(tmp_path / "out")).where("topic = 'copy'").count() == 4


def test_signal_stops_a_running_job(spark, tmp_path, monkeypatch):
    """What has arrived by then is processed."""
    topic = Topic(spark, tmp_path / "in")
    topic.send(H.four())
    monkeypatch.setattr(command, "WAIT_S", 0.2)
    before = signal.getsignal(signal.SIGTERM)

    def stop():
        while signal.getsignal(signal.SIGTERM) is signal.SIG_IGN:
            time.sleep(0.1)
        os.kill(os.getpid(), signal.SIGTERM)

    path = write_properties(
        tmp_path,
        kafka__topic="t",
        spark__interval=1,
        input__format="parquet",
        input__path=tmp_path / "in",
        input__encoding="json",
        output__format="parquet",
        output__path=tmp_path / "out",
        spark__checkpointPath=tmp_path / "positions",
    )
    signal.signal(signal.SIGTERM, signal.SIG_IGN)
    try:
        threading.Thread(target=stop, daemon=True).start()
        command.main(["heat_1s", path])
    finally:
        signal.signal(signal.SIGTERM, before)
    assert current(spark, str(tmp_path / "out"), tables=["HEAT"]).count() == 4


def test_backfills_replace_nothing_of_each_other(spark, tables, tmp_path):
    """Two tables, and two buckets of one table, in one store, by the command."""
    for name, df in tables[1].items():
        df.createOrReplaceTempView(name)
    days = dict(startDay=DAYS[0], endDay=DAYS[1], output__path=tmp_path / "out")
    stored, counts = str(tmp_path / "out"), []
    for table, target, bucket in (("one", "G", 1), ("two", "H", 1000), ("one", "G", 600_000)):
        settings = dict(hiveTable=table, hbaseTable=target, sampleTime=bucket)
        command.main(["gaswater_backfill", write_properties(tmp_path, **days, **settings)])
        counts.append(current(spark, stored).count())
    assert counts[0] == 45 and counts[1] > counts[0] and counts[2] == counts[1]


def test_backfill_of_catalog_tables(spark, tables, tmp_path):
    """Partitions come from the session's catalog, and days at both ends are left out."""
    source = str(tmp_path / "table")
    tables[1]["one"].write.partitionBy("dt").parquet(source)
    spark.sql("CREATE DATABASE IF NOT EXISTS plant")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tables[1]["one"].schema)
    spark.sql(f"CREATE TABLE plant.days ({fields}) USING parquet PARTITIONED BY (dt) LOCATION '{source}'")
    try:
        spark.sql("ALTER TABLE plant.days RECOVER PARTITIONS")
        table = named_tables(spark, ["plant.days"])["plant.days"]
        days = sorted(r["dt"] for r in table.select("dt").distinct().collect())
        assert len(days) == 4
        rows = tables_and_days({"plant.days": table}, days[1], days[2])
        assert {r["dt"] for r in rows.select("dt").distinct().collect()} == set(days[1:3])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan
        settings = dict(hiveTable="plant.days", hbaseTable="G", startDay=days[1], endDay=days[2])
        path = write_properties(tmp_path, output__path=tmp_path / "out", sampleTime=1, **settings)
        command.main(["gaswater_backfill", path])
        assert current(spark, str(tmp_path / "out")).count() == rows.count() == 30
    finally:
        spark.sql("DROP TABLE plant.days")


@pytest.mark.parametrize("name, expected", [("water_flow", {1, 5}), ("gas_1s", {1, 5})])
def test_command_runs_an_exact_job(spark, tmp_path, name, expected):
    """Rows of a bucket come in two batches, and one after it was given out."""
    topic = Topic(spark, tmp_path / "in")
    sent = [
        H.four()[2:],
        [*H.four()[:2], reading(5, time=BASE_TIME + 7_200_000)],
        [reading(6, time=BASE_TIME + 20_000_000)],
        [reading(7, time=BASE_TIME - 500), reading(8, time=BASE_TIME + 21_000_000)],
    ]
    for rows in sent:
        topic.send(rows)
    settings = dict(kafka__topic="t", input__format="parquet", input__path=tmp_path / "in", input__encoding="json")
    settings |= dict(input__maxPerBatch=1, output__format="parquet", output__path=tmp_path / "out", once="true")
    settings |= dict(spark__checkpointPath=tmp_path / "positions", sample__exact="true", sample__delayMs=1000)
    command.main([name, write_properties(tmp_path, **settings)])
    out = str(tmp_path / "out")
    table = {"water_flow": "WATER_FLOW", "gas_1s": "GAS_1S"}[name]
    rows = current(spark, out, tables=[table]).where(F.col("event_time") < BASE_TIME + 10_000_000)
    assert {r["seq"] for r in rows.collect()} == expected
    assert [r["seq"]["offset"] for r in late_readings(spark, out).collect()] == [7]

from __future__ import annotations

from datetime import date

import pytest
from gaugeflow.operators import routing
from gaugeflow.operators.lookup import topic_map, with_topic
from gaugeflow.plans.jobs import JOBS
from gaugeflow.plans.runner import job_rows, run_batch
from gaugeflow.schema import FLOW_COLUMNS, MESSAGE
from gaugeflow.session import _local_folder, shared_folder
from gaugeflow.sinks import changes
from gaugeflow.sinks.cells import cell_rows, sorted_cells
from gaugeflow.sinks.messages import message_rows, split_unrouted
from pyspark.sql import functions as F

from helpers import BASE_TIME, four, frame, reading

DAY = 86_400_000


def keyed(spark, rows, table="T", floor=1000):
    return routing.stored_rows(frame(spark, rows), table, floor)


def held(df):
    return sorted((r["table_name"], r["seq"]) for r in df.collect())


def test_bridge_tables(spark):
    rows = [reading(i, dataType=t) for i, t in enumerate(["PV", "FFT", "S10M", "RMS"])]
    df = frame(spark, rows)

    def names(column):
        return [r["n"] for r in df.select("seq", column.alias("n")).orderBy("seq").collect()]

    assert names(routing.bridge_detail_table()) == [
        "BRIDGE_T1",
        "BRIDGE_FFT",
        "BRIDGE_OTHER_DATATYPE",
        "BRIDGE_OTHER_DATATYPE",
    ]
    assert names(routing.bridge_detail_table(legacy_names=True))[2] == "BRIDGE_T1_"
    assert names(routing.bridge_sample_table())[0] == "BRIDGE_T1_1S"
    assert routing.kind_of("gas_1s") == routing.SAMPLE
    assert routing.kind_of("GAS") == routing.DETAIL


def test_topics(spark):
    topics = topic_map({"acce": "A1,A2", "strain": "A2"})
    assert topics["A1"].endswith("ACCE-HIVE")
    assert topics["A2"].endswith("STRAIN-HIVE")
    assert "ACCE" not in topics
    df = with_topic(frame(spark, [reading(1, monitoring="A1"), reading(2, monitoring="other")]), topics)
    got = {r["seq"]: r["topic"] for r in df.collect()}
    assert got[1].endswith("ACCE-HIVE") and got[2] is None
    routed, unrouted = split_unrouted(message_rows(df, F.col("topic")))
    assert (routed.count(), unrouted.count()) == (1, 1)


def test_stored_row(spark):
    (row,) = keyed(spark, four()[3:], "T", None).collect()
    assert row["rowkey"] == "4c9252:T1:S1:9223370530866019907"
    assert (row["time"], row["seconds"], row["values"]) == ("2017-09-21 10:12:35:900", "35", "0.5,30.0")
    assert row["key_day"] == date(2017, 9, 21)


def test_last_writer_wins(spark, tmp_path):
    root = str(tmp_path)
    late_but_older = reading(9, time=BASE_TIME + 1)
    changes.write_changes(keyed(spark, four()[:2]), root, 0)
    assert held(changes.current(spark, root)) == [("T", 2)]
    changes.write_changes(keyed(spark, [late_but_older]), root, 1)
    assert held(changes.current(spark, root)) == [("T", 9)]


def test_locations_share_a_row_key(spark, tmp_path):
    root = str(tmp_path)
    rows = [reading(1), reading(2, location="L2", time=BASE_TIME + 1)]
    changes.write_changes(keyed(spark, rows), root, 0)
    assert held(changes.current(spark, root)) == [("T", 2)]


def test_nothing_written(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        changes.current(spark, str(tmp_path))


def test_empty_batch(spark, tmp_path):
    root = str(tmp_path)
    changes.write_changes(keyed(spark, four()).where("false"), root, 0)
    assert held(changes.current(spark, root)) == []


def test_writers_do_not_replace_each_other(spark, tmp_path):
    """The same batch number, exact keys: all rows stay, whoever wrote them."""
    root = str(tmp_path)
    for i, writer in enumerate(("a-1", "a", "backfill-1", "backfill-2")):
        changes.write_changes(keyed(spark, [reading(i, sensor=f"S{i}")]), root, 0, writer)
    assert held(changes.current(spark, root)) == [("T", i) for i in range(4)]


def test_rows_of_messages_and_tables_share_a_store(spark, tmp_path):
    root = str(tmp_path)
    rows = frame(spark, [reading(1)])
    place = F.struct(F.lit(5).cast("bigint").alias("offset"), F.lit(0).alias("partition"), F.lit("t").alias("topic"))
    changes.write_changes(routing.stored_rows(rows.withColumn("seq", place), "M", None), root, 0, "stream")
    changes.write_changes(routing.stored_rows(rows.drop("seq"), "B", None), root, 0, "backfill-1")
    stored = {r["table_name"]: (r["seq"], r["seq_topic"]) for r in changes.current(spark, root).collect()}
    assert stored == {"M": (5, "t"), "B": (None, None)}


def test_some_days(spark, tmp_path):
    root = str(tmp_path)
    rows = [reading(1), reading(2, time=BASE_TIME + DAY), reading(3, time=BASE_TIME + DAY, sensor="S3")]
    changes.write_changes(keyed(spark, rows), root, 0)
    assert held(changes.current(spark, root, days=[date(2017, 9, 22)])) == [("T", 2), ("T", 3)]
    assert held(changes.current(spark, root, days=[date(2017, 9, 30)])) == []
    assert held(changes.current(spark, root, tables=["U"])) == []


def test_flow_rows_have_no_seconds(spark):
    rows = job_rows(JOBS["water_flow"], frame(spark, four()))
    assert "seconds" not in rows.columns
    assert set(FLOW_COLUMNS) <= set(rows.columns)


def test_features_keep_the_last_row_of_a_bucket(spark, tmp_path):
    root = str(tmp_path)
    rows = [reading(i, dataType="S10M", time=BASE_TIME + i * 1000) for i in range(3)]
    run_batch(JOBS["bridge_10m"], frame(spark, rows), root, 0)
    assert held(changes.current(spark, root)) == [("BRIDGE_FEATURE_10M", 2)]
    sent = spark.read.schema(MESSAGE).parquet(f"{root}/messages")
    assert [r["topic"] for r in sent.collect()] == ["CLLSEN-BRIDGE-HF-FEATURE"] * 3


def test_bridge_batch(spark, tmp_path):
    root = str(tmp_path)
    rows = [*four(), reading(8, sensor="S8", monitoring="UNMAPPED")]
    run_batch(JOBS["bridge_1s"], frame(spark, rows), root, 0)
    assert held(changes.current(spark, root)) == [
        *[("BRIDGE_T1", i) for i in (1, 2, 3, 4, 8)],
        ("BRIDGE_T1_1S", 4),
        ("BRIDGE_T1_1S", 8),
    ]
    (sample,) = changes.current(spark, root, tables=["BRIDGE_T1_1S"]).where("seq = 4").collect()
    assert sample["rowkey"] == "4c9252:T1:S1:9223370530866020807"
    assert sample["values"] == "4.0,0.5,2.0"
    sent = spark.read.schema(MESSAGE).parquet(f"{root}/messages").collect()
    assert sorted(r["topic"] for r in sent) == ["CLLSEN-BRIDGE-HF-ACCE-HIVE", "UNROUTED"]


def test_empty_job_batch(spark, tmp_path):
    root = str(tmp_path)
    for name in ("gas_1s", "bridge_1s"):
        run_batch(JOBS[name], frame(spark, four()).where("false"), f"{root}/{name}", 0)
        assert held(changes.current(spark, f"{root}/{name}")) == []
        run_batch(JOBS[name], frame(spark, []), f"{root}/{name}", 1)


def test_shared_folder(spark):
    set_by_cluster = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(set_by_cluster + "/gaugeflow/x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _local_folder("yarn")


def test_water_batch(spark, tmp_path):
    root = str(tmp_path)
    other = [reading(10 + i, sensorType="FLOW", sensor="F", time=BASE_TIME + i) for i in range(2)]
    run_batch(JOBS["water_1s"], frame(spark, [*four(), *other]), root, 0)
    assert held(changes.current(spark, root, tables=["WATER_1S"])) == [("WATER_1S", 4), ("WATER_1S", 11)]
    assert len(held(changes.current(spark, root, tables=["WATER"]))) == 6


def test_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        changes.write_changes(keyed(spark, four(), floor=None), root, 0)
    assert held(changes.current(spark, root)) == [("T", i) for i in (1, 2, 3, 4)]


def test_the_last_write_wins_whoever_makes_it(spark, tmp_path):
    """A, B, A in turn, with batch numbers and names that sort otherwise."""
    root = str(tmp_path)
    changes.write_changes(keyed(spark, [reading(1), reading(7, sensor="A")]), root, 9, "z")
    changes.write_changes(keyed(spark, [reading(2), reading(8, sensor="B")]), root, 0, "a")
    assert ("T", 2) in held(changes.current(spark, root))
    changes.write_changes(keyed(spark, [reading(3)]), root, 3, "z")
    assert held(changes.current(spark, root)) == [("T", 3), ("T", 7), ("T", 8)]


def test_stamps_grow(monkeypatch):
    first = changes.write_stamp()
    monkeypatch.setattr(changes.time, "time_ns", lambda: 0)
    assert changes.write_stamp() == first + 1


def test_rows_are_counted_as_they_are_written(spark, tmp_path, caplog):
    with caplog.at_level("INFO"):
        counts = run_batch(JOBS["gas_1s"], frame(spark, four()), str(tmp_path), 7)
    assert counts == {"GAS_1S": 1, "GAS": 4}
    assert "gas_1s: batch 7, rows written: GAS 4, GAS_1S 1" in caplog.text
    rows = [reading(i, dataType=t, sensor=f"S{i}") for i, t in enumerate(["PV", "PV", "FFT", "RMS"])]
    assert run_batch(JOBS["bridge_1s"], frame(spark, rows), str(tmp_path / "b"), 0) == {
        "BRIDGE_*": 2,
        "BRIDGE_*_1S": 2,
        "BRIDGE_FFT": 1,
        "BRIDGE_OTHER_DATATYPE": 1,
    }


def test_cells(spark, tmp_path):
    root = str(tmp_path)
    rows = [reading(1, time=BASE_TIME + 5), reading(2, level=-1), reading(3, sensor="S2")]
    run_batch(JOBS["water_flow"], frame(spark, rows), root, 4, cells=True)
    cells = spark.read.parquet(f"{root}/cells/writer=only/batch_id=4").collect()
    assert len(cells) == 2 * 8 and {c["family"] for c in cells} == {"M"}
    one = {c["qualifier"]: bytes(c["value"]) for c in cells if ":S1:" in c["rowkey"]}
    assert one["level"] == b"\xff\xff\xff\xff" and one["rtime"] == bytes(8)
    assert one["time"] == b"2017-09-21 10:12:35:000" and "seconds" not in one
    nine = cell_rows(keyed(spark, [reading(1, location=None)], floor=None))
    assert nine.count() == 8


def test_cells_are_sorted_in_ranges(spark):
    rows = [reading(i, sensor=f"S{i % 50}", time=BASE_TIME + i) for i in range(400)]
    cells = sorted_cells(keyed(spark, rows, floor=None)).select(
        F.spark_partition_id().alias("p"), "table_name", "rowkey", "qualifier"
    )
    got = [tuple(r) for r in cells.collect()]
    assert len(got) == 400 * 9 and got == sorted(got)
    assert [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_ranges_of_cells_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr("gaugeflow.sinks.cells.ROWS_PER_RANGE", 50)
    rows = [reading(i, sensor=f"S{i % 40}", time=BASE_TIME + i) for i in range(1000)]
    cells = sorted_cells(keyed(spark, rows, floor=None)).withColumn("range", F.spark_partition_id())
    sizes = [r["count"] for r in cells.groupBy("range").count().collect()]
    assert sum(sizes) == 9 * 1000 and max(sizes) <= 2 * 9 * 50
    assert sorted_cells(keyed(spark, [], floor=None)).count() == 0

from __future__ import annotations

import random
from datetime import datetime

import pytest
from catalog import base
from gaugeflow.operators import sampling
from gaugeflow.operators.sampling import sample_state
from gaugeflow.plans.jobs import JOBS
from gaugeflow.plans.runner import run_exact_batch, start_exact_job, start_job
from gaugeflow.schema import MESSAGE
from gaugeflow.session import write_out
from gaugeflow.sinks.changes import current
from gaugeflow.sources.messages import decode_json, topic_stream
from gaugeflow.streaming import batches, event_time
from gaugeflow.streaming.copy import pace_options, start_copy
from gaugeflow.streaming.partials import Partials, last_seen, late_readings, mark_seen
from pyspark.sql import functions as F

import helpers as H
from helpers import BASE_TIME, four, frame, reading


class Topic:
    """A folder of message files; each call of ``send`` adds one file."""

    def __init__(self, spark, path, name="t"):
        self.spark, self.path, self.name = spark, str(path), name

    def send(self, rows):
        offsets = frame(self.spark, rows)
        (
            offsets.select(
                F.lit(None).cast("string").alias("key"),
                F.to_json(F.struct(*[c for c in offsets.columns if c != "seq"]))
                .cast("binary")
                .alias("value"),
                F.lit(0).alias("partition"),
                F.col("seq").alias("offset"),
                F.lit(self.name).alias("topic"),
            )
            .coalesce(1)
            .write.mode("append")
            .partitionBy("topic")
            .parquet(self.path)
        )

    def readings(self, **options):
        stream = topic_stream(self.spark, [self.name], "parquet", path=self.path, **options)
        return decode_json(stream).withColumn("seq", F.col("seq.offset"))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "in")


def held(spark, root, table):
    rows = current(spark, root, tables=[table]).collect()
    return sorted((r["seq"], r["values"]) for r in rows)


def drain_job(spec, topic, tmp_path):
    start_job(
        spec, topic.readings(), str(tmp_path / "out"), str(tmp_path / "positions")
    ).awaitTermination()
    return str(tmp_path / "out")


def test_buckets_do_not_reach_across_batches(spark, topic, tmp_path):
    """Two batches touch one second: the second batch's earliest reading stays."""
    topic.send(four()[:2])
    root = drain_job(JOBS["gas_1s"], topic, tmp_path)
    assert held(spark, root, "GAS_1S") == [(1, "1.0,10.0")]
    topic.send(four()[2:])
    drain_job(JOBS["gas_1s"], topic, tmp_path)
    assert held(spark, root, "GAS_1S") == [(3, "2.5,20.0")]
    assert [s for s, _ in held(spark, root, "GAS")] == [1, 2, 3, 4]


def test_late_reading_overwrites(spark, topic, tmp_path):
    topic.send([reading(1), reading(2, time=BASE_TIME + 60_000)])
    root = drain_job(JOBS["heat_1s"], topic, tmp_path)
    topic.send([reading(3, time=BASE_TIME + 500)])
    drain_job(JOBS["heat_1s"], topic, tmp_path)
    assert [s for s, _ in held(spark, root, "HEAT_1S")] == [2, 3]


def test_restart_continues_after_the_last_batch(spark, topic, tmp_path):
    seen = []

    def handle(batch, batch_id):
        seen.append((batch_id, sorted(r["seq"] for r in batch.collect())))

    for rows in (four()[:1], four()[1:]):
        topic.send(rows)
        batches.run_batches(topic.readings(), handle, str(tmp_path / "p")).awaitTermination()
    assert seen == [(0, [1]), (1, [2, 3, 4])]


def test_failed_output_is_repeated_under_the_same_number(spark, topic, tmp_path):
    attempts = []

    def handle(batch, batch_id):
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("output is gone")

    topic.send(four())
    with pytest.raises(Exception, match="output is gone"):
        batches.run_batches(topic.readings(), handle, str(tmp_path / "p")).awaitTermination()
    batches.run_batches(topic.readings(), handle, str(tmp_path / "p")).awaitTermination()
    assert attempts == [0, 0]


def test_files_per_batch(spark, topic, tmp_path):
    for row in four():
        topic.send([row])
    sizes = []
    batches.run_batches(
        topic.readings(max_per_batch=1), lambda b, i: sizes.append(b.count()), str(tmp_path / "p")
    ).awaitTermination()
    assert sizes == [1, 1, 1, 1]


def test_interval_and_stop(spark, topic, tmp_path):
    topic.send(four())
    counts = []
    query = batches.run_batches(
        topic.readings(), lambda b, i: counts.append(b.count()), str(tmp_path / "p"), interval_s=1
    )
    batches.drain([query])
    assert counts == [4] and not query.isActive


def random_rows(seed):
    rng = random.Random(seed)
    return [
        reading(
            seq,
            sensor=f"S{rng.randrange(3)}",
            time=rng.randrange(10_000),
            level=rng.randrange(3),
            values=[H.float32(rng.uniform(0, 9))],
        )
        for seq in range(200)
    ]


def drained(spark, rows, tmp_path):
    (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "rows"))
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(str(tmp_path / "rows"))


CLOSER = reading(999, sensor="closer", time=10_000_000)


def test_exact_earliest_over_batches(spark, topic, tmp_path):
    rows = random_rows(0)
    for part in (rows[:70], rows[70:140], [*rows[140:], CLOSER]):
        topic.send(part)
    stream = event_time.exact_earliest(topic.readings(max_per_batch=1), 1000, delay_ms=60_000)
    assert H.seqs(drained(spark, stream, tmp_path)) == H.earliest(rows, 1000)


def test_exact_stats_over_batches(spark, topic, tmp_path):
    rows = random_rows(1)
    for part in (rows[:100], [*rows[100:], CLOSER]):
        topic.send(part)
    stream = event_time.exact_head_stats(topic.readings(max_per_batch=1), 1000, delay_ms=60_000)
    got = H.seqs_and_values(drained(spark, stream, tmp_path))
    expected = H.head_stats(rows, 1000, H.max_level)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    for key, (_, values) in expected.items():
        assert got[key][1] == pytest.approx(values, rel=1e-6)


def test_exact_channels_over_batches(spark, topic, tmp_path):
    rows = [{**r, "values": [*r["values"], float(r["seq"]), 1.0]} for r in random_rows(3)]
    for part in (rows[:100], [*rows[100:], CLOSER]):
        topic.send(part)
    stream = event_time.exact_channel_stats(topic.readings(max_per_batch=1), 1000, delay_ms=60_000)
    got = H.seqs_and_values(drained(spark, stream, tmp_path))
    expected = sampling.channel_stats(frame(spark, rows), 1000, sampling.MAX_LEVEL)
    assert got == H.seqs_and_values(expected)


def test_copy(spark, topic, tmp_path):
    topic.send(four())
    source = topic_stream(spark, ["t"], "parquet", path=topic.path)
    query = start_copy(source, "copied", str(tmp_path / "p"), "parquet", path=str(tmp_path / "o"))
    query.awaitTermination()
    rows = spark.read.schema(MESSAGE).parquet(str(tmp_path / "o"))
    original = spark.read.schema(MESSAGE).parquet(topic.path)
    assert {(r["topic"], r["key"], bytes(r["value"])) for r in rows.collect()} == {
        ("copied", None, bytes(r["value"])) for r in original.collect()
    }
    assert pace_options({"input.maxPerBatch": "200000"}) == {"maxOffsetsPerTrigger": "200000"}
    assert pace_options({}) == {}


def test_only_the_named_topics(spark, tmp_path):
    for name in ("a", "b", "c"):
        Topic(spark, tmp_path / "in", name).send([reading(1)])
    stream = topic_stream(spark, ["a", "c"], "parquet", path=str(tmp_path / "in"))
    rows = drained(spark, stream, tmp_path)
    assert sorted(r["topic"] for r in rows.collect()) == ["a", "c"]


def test_state_is_small(spark):
    """A group of any size keeps two readings."""
    rows = [reading(i, time=BASE_TIME + i % 1000) for i in range(500)]
    (row,) = write_out(sample_state(frame(spark, rows, 4), 1000), "state").collect()
    assert row["n_rows"] == 500
    assert (row["last"]["seq"], row["prev"]["seq"]) == (499, 498)


# --- partial states and exact jobs --------------------------------------------------------------------


def all_rows(partials, spark, schema, *bounds):
    return partials.sampled(spark, schema, *bounds)


@pytest.mark.parametrize("mode", ["last_pair", "max_level"])
@pytest.mark.parametrize("sampler", ["earliest", "head_stats", "channel_stats"])
def test_merged_partials_are_exact(spark, tmp_path, sampler, mode):
    """Whatever batches the readings of a bucket come in; a repeated batch changes nothing."""
    rows = [{**r, "values": [*r["values"], float(r["seq"])]} for r in random_rows(2)]
    options = {} if sampler == "earliest" else {"mode": mode}
    partials = Partials(str(tmp_path), sampler, 1000, options)
    for batch_id, part in enumerate((rows[:50], rows[50:120], rows[120:], rows[120:])):
        schema = partials.write(frame(spark, part, 3), min(batch_id, 2))
    whole = sampling.SAMPLERS[sampler](frame(spark, rows), 1000, **options)
    want, got = H.seqs_and_values(whole), H.seqs_and_values(all_rows(partials, spark, schema))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for key, (_, values) in want.items():
        assert got[key][1] == pytest.approx(values, rel=1e-6)
    some = all_rows(partials, spark, schema, 3000, 6000)
    assert H.seqs(some) == {k: v[0] for k, v in want.items() if 3 <= k[3] <= 5}


def test_partials_of_readings_without_channels(spark, tmp_path):
    rows = [reading(1, values=[]), reading(2, time=BASE_TIME + 1, values=[])]
    partials = Partials(str(tmp_path), "channel_stats", 1000, {})
    for i, row in enumerate(rows):
        schema = partials.write(frame(spark, [row]), i)
    assert [list(r["values"]) for r in all_rows(partials, spark, schema).collect()] == [[]]
    schema = partials.write(frame(spark, [reading(3, time=BASE_TIME + 2, values=[1.0])]), 2)
    with pytest.raises(Exception, match="fewer channels"):
        all_rows(partials, spark, schema).collect()


def test_states_of_some_days_are_listed_alone(spark, tmp_path):
    day = 86_400_000
    partials = Partials(str(tmp_path), "earliest", 1000, {})
    rows = [reading(i, time=BASE_TIME + i * day) for i in range(4)]
    schema = partials.write(frame(spark, rows), 0)
    start = BASE_TIME // day * day
    some = partials.states(spark, schema, start + day, start + 3 * day)
    assert {r["row"]["seq"] for r in some.collect()} == {1, 2}
    assert len(some.inputFiles()) == 2
    assert "PartitionFilters: [isnotnull(bucket_day" in some._jdf.queryExecution().executedPlan().toString()
    partials.drop_spent(spark, start + 2 * day + 5000)
    assert {r["row"]["seq"] for r in partials.states(spark, schema).collect()} == {2, 3}


def test_marks(spark, tmp_path):
    root = str(tmp_path)
    assert last_seen(spark, root, 5) is None
    for batch, seen in ((0, 10), (1, 30), (2, 30), (2, 30)):
        mark_seen(spark, root, batch, seen)
    assert [last_seen(spark, root, n) for n in (0, 1, 2, 9)] == [None, 10, 30, 30]
    mark_seen(spark, root, 40, 50)
    assert last_seen(spark, root, 40) is None and last_seen(spark, root, 41) == 50


def test_repeated_exact_batch_gives_the_same(spark, tmp_path):
    """A batch that fails after its outputs starts again from what the batch before it had seen."""
    root, spec = str(tmp_path), JOBS["water_flow"]
    parts = [
        four(),
        [reading(5, time=BASE_TIME + 7_200_000), reading(6, time=BASE_TIME - 10)],
        [reading(7, time=BASE_TIME), reading(8, time=BASE_TIME + 14_400_000)],
    ]
    for batch_id, rows in enumerate(parts):
        for _ in range(2):
            run_exact_batch(spec, frame(spark, rows), root, batch_id, 1000)
    assert held(spark, root, "WATER_FLOW") == [(5, "1.0"), (6, "1.0")]
    assert [r["seq"] for r in late_readings(spark, root).collect()] == [7]
    run_exact_batch(spec, frame(spark, []), root, 3, 1000)
    assert len(held(spark, root, "WATER_FLOW")) == 2


def test_an_exact_job_equals_sampling_at_once(spark, topic, tmp_path):
    rows = [{**r, "dataType": "PV"} for r in random_rows(7)]
    closers = [reading(990 + i, sensor="closer", time=10_000_000 * (i + 1)) for i in range(2)]
    for part in (rows[:60], rows[60:150], [*rows[150:], closers[0]], closers[1:]):
        topic.send(part)
    job = start_exact_job(
        JOBS["bridge_1s"], topic.readings(max_per_batch=1), str(tmp_path / "out"), str(tmp_path / "p"), 60_000
    )
    job.awaitTermination()
    got = {r["seq"]: r["values"] for r in current(spark, str(tmp_path / "out"), tables=["BRIDGE_T1_1S"]).collect()}
    want = {seq: values for seq, values in H.head_stats(rows, 1000).values()}
    assert set(got) - {990} == set(want)
    for seq, values in want.items():
        assert [float(v) for v in got[seq].split(",")] == pytest.approx(values, rel=1e-6)
    sent = spark.read.schema(MESSAGE).parquet(str(tmp_path / "out/messages"))
    assert sent.count() == len(got)


def test_a_batch_of_arrival_is_dealt_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(base, "FILE_ROWS", 4)
    ids = [i for i in range(1, 60) if i % 7]
    day = {n: 8 * (0 if n < 30 else 2 if n < 33 else 3) for n in range(len(ids))}  # 30, 0, 3 and the rest
    rows = [(i, datetime(2024, 1, 1 + day[n], n % 24), 1, "click", 1.0, '{"k": 1}') for n, i in enumerate(ids)]
    events = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    stream = base.batched_topic_stream(spark, base.TOPICS, str(tmp_path))
    got = {}

    def handle(batch, batch_id):
        got[batch_id] = sorted(r["offset"] for r in batch.collect())

    batches.run_batches(stream, handle, f"{tmp_path}/positions").awaitTermination()
    assert got == {0: ids[:30], 1: [], 2: ids[30:33], 3: ids[33:]}
    assert base.files_per_batch(spark, base.batched_message_folder(spark, str(tmp_path))) == 8

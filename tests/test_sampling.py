from __future__ import annotations

import random

import pytest
from catalog import ORACLES, QUERIES
from catalog.base import readings
from gaugeflow.operators import filters, sampling
from gaugeflow.session import write_out

import helpers as H
from helpers import four, frame, reading


class close:
    """Equal maps of ``seq, values``; means may differ in the last float digit."""

    def __init__(self, expected):
        self.expected = expected

    def __eq__(self, got):
        assert got.keys() == self.expected.keys()
        for key, (seq, values) in self.expected.items():
            assert got[key][0] == seq
            assert got[key][1] == pytest.approx(values, rel=1e-6, abs=1e-6)
        return True


def only(df):
    (row,) = df.collect()
    return row


def test_hand_made_rows(spark):
    df = frame(spark, four())
    assert only(sampling.earliest(df, 1000))["seq"] == 1
    assert only(sampling.representative(df, 1000))["seq"] == 4
    assert only(sampling.representative(df, 1000, sampling.MAX_LEVEL))["seq"] == 2
    assert list(only(sampling.head_stats(df, 1000))["values"]) == [4.0, 0.5, 2.0]
    channels = only(sampling.channel_stats(df, 1000))
    assert list(channels["values"]) == [4.0, 0.5, 2.0, 40.0, 10.0, 25.0]
    assert channels["seq"] == 4
    assert list(only(sampling.conditional_stats(df, 1000))["values"]) == [0.5, 30.0]


def test_last_pair_prefers_the_higher_level_of_the_two(spark):
    rows = four()[:3]
    assert only(sampling.representative(frame(spark, rows), 1000))["seq"] == 2
    rows[1]["level"] = rows[2]["level"] = 0
    assert only(sampling.representative(frame(spark, rows), 1000))["seq"] == 3


def test_single_reading(spark):
    df = frame(spark, [reading(7, values=[3.0], level=-1)])
    for mode in (sampling.LAST_PAIR, sampling.MAX_LEVEL):
        row = only(sampling.head_stats(df, 1000, mode))
        assert (row["seq"], list(row["values"])) == (7, [3.0, 3.0, 3.0])
    assert list(only(sampling.conditional_stats(df, 1000))["values"]) == [3.0, 3.0, 3.0]


def test_equal_times_are_ordered_by_rtime_then_seq(spark):
    rows = [reading(1, rtime=5), reading(2, rtime=3), reading(3, rtime=3)]
    df = frame(spark, rows)
    assert only(sampling.earliest(df, 1000))["seq"] == 2
    assert only(sampling.representative(df, 1000))["seq"] == 1


def test_ties_without_seq_are_settled_by_the_other_columns(spark):
    rows = [reading(i, values=[float(v)]) for i, v in enumerate([3, 1, 2])]
    for partitions in (1, 3):
        df = frame(spark, rows, partitions).drop("seq")
        assert list(only(sampling.earliest(df, 1000))["values"]) == [1.0]
        assert list(only(sampling.representative(df, 1000))["values"]) == [3.0]


def test_locations_are_separate_groups(spark):
    df = frame(spark, [reading(1), reading(2, location="L2")])
    assert sampling.earliest(df, 1000).count() == 2


def test_underscores_do_not_mix_groups(spark):
    rows = [reading(1, location="a_b", terminal="c"), reading(2, location="a", terminal="b_c")]
    assert sampling.earliest(frame(spark, rows), 1000).count() == 2


def test_nan_is_the_greatest_value(spark):
    rows = [reading(1, values=[float("nan")]), reading(2, values=[2.0]), reading(3, values=[1.0])]
    v_max, v_min, v_mean = only(sampling.head_stats(frame(spark, rows), 1000))["values"]
    assert v_max != v_max and v_min == 1.0 and v_mean != v_mean


def test_empty_values(spark):
    rows = [reading(1, values=[]), reading(2, values=[2.0]), reading(3, values=[4.0])]
    df = frame(spark, rows)
    for sampler in (sampling.head_stats, sampling.conditional_stats):
        with pytest.raises(Exception, match="without a first channel"):
            sampler(df, 1000).collect()
        assert list(only(sampler(df, 1000, on_empty="skip"))["values"]) == [4.0, 2.0, 3.0]


def test_empty_values_do_not_matter_when_the_representative_is_kept(spark):
    rows = [reading(1, values=[]), reading(2, values=[2.0, 5.0])]
    assert list(only(sampling.conditional_stats(frame(spark, rows), 1000))["values"]) == [2.0, 5.0]


def test_ragged_channels(spark):
    rows = [reading(1, values=[1.0]), reading(2, values=[2.0, 9.0, 7.0]), reading(3, values=[3.0, 5.0])]
    df = frame(spark, rows)
    with pytest.raises(Exception, match="fewer channels"):
        sampling.channel_stats(df, 1000).collect()
    got = only(sampling.channel_stats(df, 1000, on_ragged="skip"))["values"]
    assert list(got) == [3.0, 1.0, 2.0, 9.0, 5.0, 7.0]
    # Channels that the representative lacks are left out.
    assert list(only(sampling.channel_stats(frame(spark, rows[1:]), 1000))["values"])[3:] == [9.0, 5.0, 7.0]


def test_representative_without_channels(spark):
    rows = [reading(1, values=[1.0]), reading(2, time=H.BASE_TIME + 1, values=[])]
    assert list(only(sampling.channel_stats(frame(spark, rows), 1000))["values"]) == []


@pytest.mark.parametrize("missing", ["location", "terminal", "sensor", "time"])
def test_a_reading_without_key_is_an_error(spark, missing):
    df = frame(spark, [reading(1, **{missing: None}), reading(2)])
    with pytest.raises(Exception, match=f"reading without {missing}"):
        sampling.head_stats(df, 1000).collect()


def test_filters(spark):
    rows = [
        reading(1),
        reading(2, dataType="FFT", sensorType="FLOW"),
        reading(3, dataType="S10M", sensorType="S10M"),
    ]
    df = frame(spark, rows)

    def kept(name):
        return sorted(r["seq"] for r in filters.FILTERS[name](df).collect())

    assert kept("all") == [1, 2, 3]
    assert kept("point_values") == [1]
    assert kept("features") == [3]
    assert kept("features_by_sensor_type") == [3]
    assert kept("high_pressure") == [1]
    assert kept("not_high_pressure") == [2, 3]


def random_rows(seed, n=300, channels=None):
    rng = random.Random(seed)
    hot = rng.random() < 0.5
    rows = []
    for seq in range(n):
        sensor = 0 if hot and rng.random() < 0.4 else rng.randrange(4)
        width = channels if channels is not None else rng.choice([1, 1, 2])
        rows.append(
            reading(
                seq,
                location=f"L{rng.randrange(2)}",
                sensor=f"S{sensor}",
                time=rng.randrange(-2500, 4000),
                rtime=rng.randrange(3),
                level=rng.randrange(-1, 3),
                values=[H.float32(rng.uniform(-5, 5)) for _ in range(width)],
            )
        )
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_samplers_match_the_plain_definition(spark, seed):
    """Whatever the order and the partitioning of the input."""
    rows = random_rows(seed)
    random.Random(seed + 100).shuffle(rows)
    df = frame(spark, rows, partitions=1 + seed * 3)
    bucket = [500, 1000, 3000][seed % 3]
    assert H.seqs(sampling.earliest(df, bucket)) == H.earliest(rows, bucket)
    assert H.seqs_and_values(sampling.head_stats(df, bucket)) == close(
        H.head_stats(rows, bucket)
    )
    by_level = sampling.head_stats(df, bucket, sampling.MAX_LEVEL)
    assert H.seqs_and_values(by_level) == close(H.head_stats(rows, bucket, H.max_level))
    assert H.seqs_and_values(sampling.conditional_stats(df, bucket)) == close(
        H.conditional_stats(rows, bucket)
    )


@pytest.mark.parametrize("seed", range(3))
def test_channel_stats_match_the_plain_definition(spark, seed):
    rows = random_rows(seed, channels=5)
    got = H.seqs_and_values(sampling.channel_stats(frame(spark, rows, 3), 1000))
    assert got == close(H.channel_stats(rows, 1000))


@pytest.mark.parametrize("seed", range(3))
def test_merged_states_equal_one_pass(spark, seed):
    rows = random_rows(seed)
    fine = write_out(sampling.sample_state(frame(spark, rows, 3), 500), "state")
    merged = sampling.merge_states(fine, 4)
    assert H.seqs_and_values(sampling.head_from_state(merged)) == close(
        H.head_stats(rows, 2000)
    )
    assert H.seqs_and_values(sampling.conditional_from_state(merged)) == close(
        H.conditional_stats(rows, 2000)
    )


def test_merging_halves_equals_the_whole(spark):
    rows = random_rows(5)
    halves = [sampling.sample_state(frame(spark, rows[i::2]), 1000) for i in range(2)]
    both = write_out(halves[0].unionByName(halves[1]), "halves")
    got = H.seqs_and_values(sampling.head_from_state(sampling.merge_states(both)))
    assert got == close(H.head_stats(rows, 1000))


def test_the_last_two_readings(spark):
    rows = [*four(), reading(9, sensor="S9")]
    got = {(r["sensor"], r["position"]): r["seq"] for r in sampling.last_two(frame(spark, rows, 3), 1000).collect()}
    assert got == {("S1", 1): 4, ("S1", 2): 3, ("S9", 1): 9}


def test_the_list_of_a_group_has_all_its_readings(spark):
    rows = [*four(), *(reading(i, time=H.BASE_TIME - i) for i in range(10, 40)), reading(9, sensor="S9")]
    got = {(r["seq"], r["position"]) for r in sampling.group_list(frame(spark, rows, 5), 2000).collect()}
    assert got == {(row["seq"], i) for g in H.groups(rows, 2000).values() for i, row in enumerate(g, start=1)}


def test_the_query_group_list_leaves_no_reading_out(spark):
    got = QUERIES["group_list"](spark, "/root/testdata/sf0.001")
    assert got.count() == readings(spark, "/root/testdata/sf0.001").count()
    assert "position <= 2" not in ORACLES["group_list"]


def test_a_group_with_most_rows(spark):
    rows = [reading(i, time=H.BASE_TIME + i % 1000, level=i % 3) for i in range(4000)]
    rows += [reading(5000 + i, sensor=f"S{i}") for i in range(2, 50)]
    assert H.seqs(sampling.representative(frame(spark, rows, 8), 1000)) == {
        k: H.last_pair(g)["seq"] for k, g in H.groups(rows, 1000).items()
    }

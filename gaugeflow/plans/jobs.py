"""The jobs: what each one reads, how it samples, and where its rows go."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column

from gaugeflow.operators.lookup import topic_map
from gaugeflow.operators.routing import (
    BRIDGE_DETAIL_FAMILIES,
    BRIDGE_FEATURE_TABLE,
    BRIDGE_FEATURE_TOPIC,
    BRIDGE_SAMPLE_FAMILIES,
    BRIDGE_TENDENCY_TABLE,
    BRIDGE_TENDENCY_TOPIC,
    SAMPLE,
    bridge_detail_table,
    bridge_sample_table,
    kind_of,
)
from gaugeflow.schema import FLOW_COLUMNS, HOUR_MS, SECOND_MS, STORED_COLUMNS, TEN_MINUTES_MS


@dataclass(frozen=True)
class Output:
    """Rows of one kind: filtered, sampled, keyed, and perhaps sent as messages.

    ``topic`` is a fixed name, or ``"by_monitoring"``, or None for no messages.
    ``options`` go to the sampler. ``named`` lists the tables that ``table`` gives, if it
    is an expression, with ``*`` for what varies; rows are counted by it.
    """

    table: str | Callable[[], Column]
    rows: str = "all"
    sampler: str = "none"
    floored: bool = False
    columns: tuple[str, ...] = tuple(STORED_COLUMNS)
    topic: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    named: tuple[str, ...] = ("*",)

    @property
    def families(self) -> tuple[str, ...]:
        return (self.table,) if isinstance(self.table, str) else self.named


@dataclass(frozen=True)
class JobSpec:
    name: str
    interval_s: int
    bucket_ms: int
    topics: tuple[str, ...]
    outputs: tuple[Output, ...]
    topic_by_monitoring: Mapping[str, str] = field(default_factory=topic_map)
    avro_schema: str | None = None

    def with_bucket(self, bucket_ms: int) -> JobSpec:
        return replace(self, bucket_ms=bucket_ms)


BY_MONITORING = "by_monitoring"

# Input topics.
BRIDGE_INPUT = (
    "CLLSEN-BRIDGE-HF-ACCE-PRO",
    "CLLSEN-BRIDGE-HF-DISPMT-PRO",
    "CLLSEN-BRIDGE-HF-DYNDEF-PRO",
    "CLLSEN-BRIDGE-HF-LOWSUMRY-PRO",
    "CLLSEN-BRIDGE-HF-STRAIN-PRO",
)
GAS_INPUT = ("CLLSEN-GAS-HF-LOWSUMRY-PRO",)
DRAIN_INPUT = ("CLLSEN-DRAIN-HF-LOWSUMRY-PRO",)
HEAT_INPUT = ("CLLSEN-HEAT-HF-LOWSUMRY-PRO",)
WATER_INPUT = ("CLLSEN-WATER-HF-LOWSUMRY-PRO",)
COPY_INPUT = ("CLLSEN-BRIDGE-HF-ACCE-DR", "CLLSEN-BRIDGE-HF-STRAIN-DR")


def earliest_per_second(name: str, topics: tuple[str, ...], sample: str, detail: str) -> JobSpec:
    """The shape of the gas, drain and heat jobs."""
    return JobSpec(
        name=name,
        interval_s=20 if name == "gas_1s" else 10,
        bucket_ms=SECOND_MS,
        topics=topics,
        outputs=(
            Output(sample, sampler="earliest", floored=kind_of(sample) == SAMPLE),
            Output(detail, floored=kind_of(detail) == SAMPLE),
        ),
    )


JOBS = {
    spec.name: spec
    for spec in (
        JobSpec(
            name="bridge_1s",
            interval_s=20,
            bucket_ms=SECOND_MS,
            topics=BRIDGE_INPUT,
            outputs=(
                Output(bridge_detail_table, named=BRIDGE_DETAIL_FAMILIES),
                Output(
                    bridge_sample_table,
                    named=BRIDGE_SAMPLE_FAMILIES,
                    rows="point_values",
                    sampler="head_stats",
                    floored=True,
                    topic=BY_MONITORING,
                ),
            ),
        ),
        JobSpec(
            name="bridge_10m",
            interval_s=600,
            bucket_ms=TEN_MINUTES_MS,
            topics=BRIDGE_INPUT,
            outputs=(
                Output(
                    BRIDGE_TENDENCY_TABLE,
                    rows="point_values",
                    sampler="head_stats",
                    floored=True,
                    topic=BRIDGE_TENDENCY_TOPIC,
                ),
                Output(
                    BRIDGE_FEATURE_TABLE,
                    rows="features",
                    floored=True,
                    topic=BRIDGE_FEATURE_TOPIC,
                ),
            ),
        ),
        JobSpec(
            name="bridge_detail",
            interval_s=20,
            bucket_ms=SECOND_MS,
            topics=("BRIDGE-DETAIL-1", "BRIDGE-DETAIL-2"),
            outputs=(Output("BRIDGE_DETAIL"),),
        ),
        earliest_per_second("gas_1s", GAS_INPUT, "GAS_1S", "GAS"),
        earliest_per_second("drain_1s", DRAIN_INPUT, "DRAIN_1S", "DRAIN"),
        earliest_per_second("heat_1s", HEAT_INPUT, "HEAT_1S", "HEAT"),
        JobSpec(
            name="water_1s",
            interval_s=10,
            bucket_ms=SECOND_MS,
            topics=WATER_INPUT,
            outputs=(
                Output("WATER_1S", rows="high_pressure", sampler="channel_stats", floored=True),
                Output("WATER_1S", rows="not_high_pressure", floored=True),
                Output("WATER"),
            ),
        ),
        JobSpec(
            name="water_flow",
            interval_s=600,
            bucket_ms=HOUR_MS,
            topics=WATER_INPUT,
            outputs=(
                Output(
                    "WATER_FLOW", sampler="earliest", floored=True, columns=tuple(FLOW_COLUMNS)
                ),
            ),
        ),
    )
}

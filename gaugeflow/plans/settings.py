"""Job settings from a properties file."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column

from gaugeflow.operators.lookup import topic_map
from gaugeflow.operators.routing import bridge_detail_table
from gaugeflow.plans.jobs import JobSpec, Output

STARTS = {"smallest": "earliest", "largest": "latest", "earliest": "earliest", "latest": "latest"}


def load_properties(path: str) -> dict[str, str]:
    """``key=value`` lines; blank lines and lines that start with # or ! are skipped."""
    settings = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            text = line.strip()
            if text and text[0] not in "#!":
                key, _, value = text.partition("=")
                settings[key.strip()] = value.strip()
    return settings


def required(settings: Mapping[str, str], *names: str) -> None:
    missing = [name for name in names if not settings.get(name)]
    if missing:
        raise SystemExit(f"missing settings: {', '.join(missing)}")


def _table_names(spec: JobSpec, settings: Mapping[str, str]) -> dict[str, str]:
    """Default table name -> configured name, the sample table first."""
    listed = settings.get("hbase.tables") or settings.get("hbase.table")
    if not listed:
        return {}
    defaults = dict.fromkeys(o.table for o in spec.outputs if isinstance(o.table, str))
    return dict(zip(defaults, listed.split(",")))


#: Setting -> sampler option, for the samplers that have it.
SAMPLER_SETTINGS = {
    "head_stats": {"sample.mode": "mode", "sample.onEmpty": "on_empty"},
    "channel_stats": {"sample.mode": "mode", "sample.onRagged": "on_ragged"},
}


def _legacy_detail_table() -> Column:
    return bridge_detail_table(legacy_names=True)


def _configured_output(output: Output, names: Mapping[str, str], settings: Mapping[str, str]) -> Output:
    known = SAMPLER_SETTINGS.get(output.sampler, {})
    options = {option: settings[name] for name, option in known.items() if name in settings}
    table = output.table
    if isinstance(table, str):
        table = names.get(table, table)
    elif table is bridge_detail_table and settings.get("legacyNames") == "true":
        table = _legacy_detail_table
    return replace(output, table=table, options=options)


def configured(spec: JobSpec, settings: Mapping[str, str]) -> JobSpec:
    """The job with its interval, topics, tables and sampler options as set."""
    names = _table_names(spec, settings)
    outputs = tuple(_configured_output(o, names, settings) for o in spec.outputs)
    topics = settings.get("kafka.topic")
    return replace(
        spec,
        interval_s=int(settings.get("spark.interval", spec.interval_s)),
        topics=tuple(topics.split(",")) if topics else spec.topics,
        outputs=outputs,
        topic_by_monitoring=topic_map(settings),
    )


def broker_options(settings: Mapping[str, str]) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings["kafka.broker.list"]}


def consumer_options(settings: Mapping[str, str]) -> dict[str, str]:
    """Options of the Kafka source. A new consumer starts at the end unless set otherwise, to a word
    or to positions of all topics and partitions as JSON; a known one goes on from its checkpoint."""
    start = settings.get("auto.offset.reset", "latest")
    options = {**broker_options(settings), "startingOffsets": STARTS.get(start.lower(), start)}
    if settings.get("kafka.groupid"):
        options["kafka.group.id"] = settings["kafka.groupid"]
    return options

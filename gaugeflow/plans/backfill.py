"""Fill the sampled tables from day tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.operators.filters import features
from gaugeflow.operators.routing import (
    BRIDGE_FEATURE_TABLE,
    BRIDGE_TENDENCY_TABLE,
    bridge_sample_table,
    stored_rows,
)
from gaugeflow.operators.sampling import (
    conditional_from_state,
    earliest,
    merge_states,
    sample_state,
)
from gaugeflow.schema import SECOND_MS, TEN_MINUTES_MS
from gaugeflow.session import write_out
from gaugeflow.sinks.changes import write_changes
from gaugeflow.sources.tables import tables_and_days

#: The writer of all backfills.
BACKFILL = "backfill"

#: Each table and each day is sampled by itself.
PER_DAY = ["source_table", "dt"]


def bridge_backfill(
    tables: Mapping[str, DataFrame],
    first: str,
    last: str,
    floor_key: bool = False,
    fine_ms: int = SECOND_MS,
    coarse_ms: int = TEN_MINUTES_MS,
    feature_column: str = "sensorType",
) -> DataFrame:
    """Stored rows of the one-second, ten-minute and feature tables.

    The readings are sampled once, at the fine bucket; the coarse rows are merged
    from that state, which is written out in between and much smaller than the input.
    Row keys hold the exact time unless ``floor_key`` is set, so they do not meet
    the rows of the streaming jobs.
    """
    if coarse_ms % fine_ms:
        raise ValueError("the coarse bucket must be a multiple of the fine one")
    readings = tables_and_days(tables, first, last)
    fine = write_out(sample_state(readings, fine_ms, PER_DAY), "state")
    coarse = merge_states(fine, coarse_ms // fine_ms, PER_DAY)  # reads the small state, not the tables

    def floor(bucket_ms: int) -> int | None:
        return bucket_ms if floor_key else None

    seconds = conditional_from_state(fine, PER_DAY)
    minutes = conditional_from_state(coarse, PER_DAY)
    raw = features(readings, feature_column)
    return (
        stored_rows(seconds, bridge_sample_table(), floor(fine_ms))
        .unionByName(stored_rows(minutes, BRIDGE_TENDENCY_TABLE, floor(coarse_ms)))
        .unionByName(stored_rows(raw, BRIDGE_FEATURE_TABLE, floor(coarse_ms)))
    )


def earliest_backfill(
    tables: Mapping[str, DataFrame],
    first: str,
    last: str,
    target: str,
    bucket_ms: int = SECOND_MS,
    floor_key: bool = False,
) -> DataFrame:
    """Stored rows of a gas or water table: the earliest reading per bucket."""
    rows = earliest(tables_and_days(tables, first, last), bucket_ms, PER_DAY)
    return stored_rows(rows, F.lit(target), bucket_ms if floor_key else None)


def run_backfill(rows: DataFrame, root: str) -> None:
    """Write one backfill run. It replaces nothing but the current rows of the keys that it has."""
    write_changes(rows, root, 0, BACKFILL)

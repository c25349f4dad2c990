"""Names of output tables and rows keyed for storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.keys import bucket_floor, row_key, time_bucket
from gaugeflow.functions.text import second_text, time_text, values_text
from gaugeflow.operators.filters import FEATURE_10M, POINT_VALUE, SPECTRUM
from gaugeflow.schema import DAY_MS, POSITION, STORED_COLUMNS, STORED_ROW

SAMPLE = "sample"
DETAIL = "detail"

# Table and topic names.
BRIDGE = "BRIDGE_"
BRIDGE_SPECTRA = "BRIDGE_FFT"
BRIDGE_OTHERS = "BRIDGE_OTHER_DATATYPE"
BRIDGE_TENDENCY_TABLE = "BRIDGE_TENDENCY_10M"
BRIDGE_FEATURE_TABLE = "BRIDGE_FEATURE_10M"
BRIDGE_TENDENCY_TOPIC = "CLLSEN-BRIDGE-HF-TENDENCY"
BRIDGE_FEATURE_TOPIC = "CLLSEN-BRIDGE-HF-FEATURE"
SAMPLE_TABLES = ("GAS_1S", "WATER_1S", "DRAIN_1S", "HEAT_1S")

#: Tables of bridge rows, ``*`` for the terminal.
BRIDGE_DETAIL_FAMILIES = ("BRIDGE_*", BRIDGE_SPECTRA, BRIDGE_OTHERS)
BRIDGE_SAMPLE_FAMILIES = ("BRIDGE_*_1S",)


def bridge_detail_table(legacy_names: bool = False) -> Column:
    """Raw bridge readings: one table per terminal, one for spectra, one for the rest.

    With ``legacy_names`` ten-minute features go to the terminal's name with a
    trailing underscore.
    """
    data_type = F.col("dataType")
    name = F.when(data_type == POINT_VALUE, F.concat(F.lit(BRIDGE), "terminal")).when(
        data_type == SPECTRUM, F.lit(BRIDGE_SPECTRA)
    )
    if legacy_names:
        name = name.when(
            data_type == FEATURE_10M, F.concat(F.lit(BRIDGE), "terminal", F.lit("_"))
        )
    return name.otherwise(F.lit(BRIDGE_OTHERS))


def bridge_sample_table() -> Column:
    return F.concat(F.lit(BRIDGE), "terminal", F.lit("_1S"))


def kind_of(table: str) -> str:
    """Whether a table of the gas, water, drain and heat jobs holds samples."""
    return SAMPLE if table.upper() in SAMPLE_TABLES else DETAIL


def stored_rows(
    df: DataFrame,
    table: Column | str,
    floor_ms: int | None,
    columns: Sequence[str] = STORED_COLUMNS,
) -> DataFrame:
    """Readings as stored rows: table, row key and columns as they are kept.

    ``floor_ms`` floors the time in the row key, so rows of a sensor in the same
    bucket replace each other. ``location`` is not part of the key. The columns
    ``event_time``, ``key_day`` and the position are kept for ordering and pruning.
    """
    name = F.lit(table) if isinstance(table, str) else table
    keyed_time = F.col("time") if floor_ms is None else bucket_floor("time", floor_ms)
    forms = {
        "seconds": second_text("time"),
        "time": time_text("time"),
        "values": values_text("values"),
    }
    return df.select(
        name.alias("table_name"),
        row_key("terminal", "sensor", "time", floor_ms).alias("rowkey"),
        *[forms.get(c, F.col(c)).alias(c) for c in columns],
        F.col("time").alias("event_time"),
        F.date_from_unix_date(time_bucket(keyed_time, DAY_MS).cast("int")).alias("key_day"),
        *_position(df),
    )


def _position(df: DataFrame) -> list[Column]:
    """The position in plain columns of one type, whether rows come from messages or tables."""
    if "seq" not in df.columns:
        parts = [F.lit(None)] * 3
    elif isinstance(df.schema["seq"].dataType, T.StructType):
        parts = [F.col("seq.offset"), F.col("seq.partition"), F.col("seq.topic")]
    else:
        parts = [F.col("seq"), F.lit(None), F.lit(None)]
    return [p.cast(STORED_ROW[c].dataType).alias(c) for p, c in zip(parts, POSITION, strict=True)]


def rows_per_table(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


def counts_by_table(families: Sequence[Sequence[str]]) -> list[Column]:
    """One sum per table name, for rows that are being written.

    A name may end in ``*`` or hold one, which stands for any text; a row counts for the first plain
    name that it has, or else for the longest pattern.
    """
    names = dict.fromkeys(name for family in families for name in family)
    ordered = sorted(names, key=lambda n: ("*" in n, -len(n)))
    name = F.coalesce("table_name", F.lit(""))
    taken, sums = F.lit(False), []
    for pattern in ordered:
        fits = name == pattern if "*" not in pattern else name.like(pattern.replace("_", r"\_").replace("*", "%"))
        sums.append(F.sum((fits & ~taken).cast("bigint")).alias(pattern))
        taken = taken | fits
    return sums

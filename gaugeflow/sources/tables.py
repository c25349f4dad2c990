"""Readings kept in tables with one partition per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schema import READING, READING_COLUMNS

#: Position of each reading field in a day table; position 7 is not used.
DAY_TABLE_POSITIONS = {
    name: position + (1 if position >= 7 else 0) for position, name in enumerate(READING_COLUMNS)
}


def positional_reading(table: DataFrame) -> list[Column]:
    """The reading fields of a day table, whatever its columns are called."""
    return [
        F.col(f"`{table.columns[position]}`").cast(READING[name].dataType).alias(name)
        for name, position in DAY_TABLE_POSITIONS.items()
    ]


def one_day(table: DataFrame, day: str) -> DataFrame:
    """One day partition. ``dt`` is compared as text, so other partitions are not listed."""
    return table.where(F.col("dt") == F.lit(day)).select(*positional_reading(table), "dt")


def day_range(table: DataFrame, first: str, last: str) -> DataFrame:
    """Day partitions from ``first`` to ``last``, both included, in one scan."""
    return table.where(F.col("dt").between(first, last)).select(
        *positional_reading(table), "dt"
    )


def tables_and_days(tables: Mapping[str, DataFrame], first: str, last: str) -> DataFrame:
    """All tables over the same days, with the table's name in ``source_table``."""
    scans = [
        day_range(table, first, last).withColumn("source_table", F.lit(name))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, scans)


def named_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.table(name) for name in names}


def day_bounds(first: str | None, last: str | None, timezone: str = "UTC") -> tuple[str, str]:
    """Both bounds, or today twice unless both are given."""
    if first and last:
        return first, last
    today = f"{datetime.now(ZoneInfo(timezone)):%Y%m%d}"
    return today, today

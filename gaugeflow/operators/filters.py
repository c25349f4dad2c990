"""Row filters of the sampling jobs; all are plain predicates that reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Codes that the readings carry.
POINT_VALUE = "PV"
SPECTRUM = "FFT"
FEATURE_10M = "S10M"
HIGH_PRESSURE = "HPRESS"


def point_values(df: DataFrame) -> DataFrame:
    return df.where(F.col("dataType") == POINT_VALUE)


def features(df: DataFrame, column: str = "dataType") -> DataFrame:
    """Ten-minute feature rows. The stream tests ``dataType``, the backfill ``sensorType``."""
    return df.where(F.col(column) == FEATURE_10M)


def high_pressure(df: DataFrame) -> DataFrame:
    return df.where(F.col("sensorType") == HIGH_PRESSURE)


def not_high_pressure(df: DataFrame) -> DataFrame:
    return df.where(F.col("sensorType") != HIGH_PRESSURE)


FILTERS = {
    "all": lambda df: df,
    "point_values": point_values,
    "features": features,
    "features_by_sensor_type": lambda df: features(df, "sensorType"),
    "high_pressure": high_pressure,
    "not_high_pressure": not_high_pressure,
}

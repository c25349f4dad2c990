"""Text forms of event times and of channel values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the stored texts.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss:SSS"
SECOND_FORMAT = "ss"


def time_text(time: Column | str) -> Column:
    """Epoch milliseconds as text in the session time zone."""
    return F.date_format(F.timestamp_millis(time), TIME_FORMAT)


def second_text(time: Column | str) -> Column:
    """Second of the minute as two digits."""
    return F.date_format(F.timestamp_millis(time), SECOND_FORMAT)


def values_text(values: Column | str) -> Column:
    """Channel values joined by commas; a missing value reads ``null``."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",", "null")

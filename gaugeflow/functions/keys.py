"""Time buckets, group keys and row keys."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_bucket(time: Column | str, bucket_ms: int) -> Column:
    """Number of the bucket; integer division that truncates towards zero."""
    return F.call_function("div", _col(time), F.lit(bucket_ms).cast("bigint"))


def bucket_floor(time: Column | str, bucket_ms: int) -> Column:
    """Start of the bucket in epoch milliseconds."""
    return time_bucket(time, bucket_ms) * F.lit(bucket_ms).cast("bigint")


def group_key(
    location: Column | str,
    terminal: Column | str,
    sensor: Column | str,
    time: Column | str,
    bucket_ms: int,
) -> Column:
    """Text form ``location_terminal_sensor_bucket``.

    For display only: samplers group by the four columns, where names that
    contain an underscore cannot run into each other.
    """
    return F.concat_ws("_", location, terminal, sensor, time_bucket(time, bucket_ms).cast("string"))


def salt_prefix(sensor: Column | str, terminal: Column | str) -> Column:
    """First six hex digits of the MD5 of sensor and terminal; spreads row keys."""
    return F.substring(F.md5(F.concat(sensor, terminal).cast("binary")), 1, 6)


def reverse_time(time: Column | str) -> Column:
    """Counts down, so the newest row of a sensor sorts first."""
    return F.lit(LONG_MAX).cast("bigint") - _col(time)


def row_key(
    terminal: Column | str,
    sensor: Column | str,
    time: Column | str,
    bucket_ms: int | None = None,
) -> Column:
    """``prefix:terminal:sensor:reversed time``; floored to ``bucket_ms`` when given."""
    keyed = _col(time) if bucket_ms is None else bucket_floor(time, bucket_ms)
    return F.concat_ws(
        ":",
        salt_prefix(sensor, terminal),
        terminal,
        sensor,
        reverse_time(keyed).cast("string"),
    )


def day_text(ts: Column | str) -> Column:
    """``yyyyMMdd`` in the session time zone; the value of a ``dt`` partition."""
    return F.date_format(ts, "yyyyMMdd")


def days_between(first: date, last: date) -> list[str]:
    """Day texts from ``first`` to ``last``, both included."""
    return [f"{first + timedelta(days=i):%Y%m%d}" for i in range((last - first).days + 1)]

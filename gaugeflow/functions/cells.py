"""Bytes of a stored cell: UTF-8 text, big-endian integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_cell(c: Column | str) -> Column:
    return F.encode(c, "UTF-8")


def _hex16(c: Column | str) -> Column:
    return F.lpad(F.hex(_col(c).cast("bigint")), 16, "0")


def long_cell(c: Column | str) -> Column:
    """Eight bytes, two's complement."""
    return F.unhex(_hex16(c))


def int_cell(c: Column | str) -> Column:
    """Four bytes, two's complement."""
    return F.unhex(F.right(_hex16(c), F.lit(8)))


def cell_map(columns: dict[str, str]) -> Column:
    """Map from column name to cell bytes.

    ``columns`` gives the Spark type of each stored column; this is the shape
    that a wide-column store connector takes.
    """
    encoders = {"string": text_cell, "bigint": long_cell, "int": int_cell}
    parts = [p for name, kind in columns.items() for p in (F.lit(name), encoders[kind](name))]
    return F.create_map(*parts)

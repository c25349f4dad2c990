"""Small helpers for columns: computed once, and rows carried beside working columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used.

    A projection may be merged into the one above it, and an array that a lambda function refers to
    would then be computed for every element. No projection moves through the generator of one row
    that stands here.
    """
    names = list(columns)
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    held = df.withColumn("_once", F.explode_outer(F.array(row)))
    others = [c for c in df.columns if c not in names]
    return held.select(*others, *[F.col("_once")[n].alias(n) for n in names])


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as the struct ``row``, and working columns, whose names can't clash with its."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(row, *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """The columns ``names`` of the rows in :func:`packed`, those in ``new`` with new values."""
    return df.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in names])

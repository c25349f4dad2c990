"""Channel values of a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_floats(values: Column | str) -> Column:
    """Any numeric array as an array of floats."""
    return (F.col(values) if isinstance(values, str) else values).cast("array<float>")


def first_channel(values: Column | str, on_empty: str = "error") -> Column:
    """Value of the first channel; an empty array raises, or gives null."""
    if on_empty == "error":
        return F.element_at(values, 1)
    return F.try_element_at(values, F.lit(1))


def float_mean(v: Column | str) -> Column:
    """Mean of floats, summed in double precision and returned as float."""
    c = F.col(v) if isinstance(v, str) else v
    return (F.sum(c.cast("double")) / F.count(F.lit(1))).cast("float")

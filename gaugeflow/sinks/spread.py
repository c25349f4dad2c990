"""Partitioning of rows that are about to be written."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, by: str, within: str) -> DataFrame:
    """Bring rows with equal ``by`` together, but a large value into several tasks.

    Adaptive execution sizes the partitions by their bytes. It is off inside stateful
    streams; there the rows are dealt to all shuffle partitions of the session.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", by)
    return rows.repartition(by, within)

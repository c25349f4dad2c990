"""Keyed rows in files: an append-only log of changes by day, and the current row of every key.

``changes/key_day=D`` holds everything that was ever written for day D, by all streams and backfills
and for all tables. Nothing is replaced or deleted. Each call of :func:`write_changes` gives its rows
one stamp, the driver's time of the call, which leads the order of rows: the current row of a key is
the one with the greatest ``(stamp, writer, batch_id, event_time, rtime, position)``. So the last write
wins, whoever made it. A batch that is repeated adds its rows again, under a later stamp, which changes
no key's current row but one that another writer has written in between; that is the order in which the
writes came. Drivers that write to one store need clocks that differ by less than a batch takes.

A key belongs to one day, so a reader of some days reads their folders alone. Tables are no
folders: a short batch with rows of thousands of terminals would leave thousands of tiny files.
Files are sorted by table and row key instead, so a reader of one table skips the other row
groups by their statistics.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.schema import POSITION, STORED_ROW
from gaugeflow.sinks.folders import children, matching
from gaugeflow.sinks.spread import spread

KEY = ["table_name", "rowkey"]
#: Order of the rows of one write, and of all rows.
IN_WRITE = ["event_time", "rtime", *POSITION]
LATEST = ["stamp", "writer", "batch_id", *IN_WRITE]

#: A row of the log.
LOGGED = T.StructType(
    [
        *STORED_ROW.fields,
        T.StructField("stamp", T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

#: The writer of a store that has one only.
ONLY = "only"

#: A file never holds more rows than this, however large its table is.
MAX_RECORDS_PER_FILE = 20_000_000

_stamps = threading.Lock()
_last_stamp = 0


def write_stamp() -> int:
    """Microseconds since 1970, greater than all stamps that this process gave before."""
    global _last_stamp
    with _stamps:
        _last_stamp = max(time.time_ns() // 1000, _last_stamp + 1)
        return _last_stamp


def write_changes(rows: DataFrame, root: str, batch_id: int, writer: str = ONLY) -> None:
    """Append the rows of one batch.

    Rows of a day are brought together, and a large day is split over many tasks.
    """
    logged = rows.withColumns(
        {"stamp": F.lit(write_stamp()), "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    (
        spread(logged, "key_day", "rowkey")
        .sortWithinPartitions("key_day", *KEY)
        .write.mode("append")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("key_day")
        .parquet(f"{root}/changes")
    )


def changes(spark: SparkSession, root: str, days: Sequence[date] | None = None) -> DataFrame:
    """All rows ever written, or those of some key days; other days are not listed."""
    path = f"{root}/changes"
    if not matching(spark, path):
        raise FileNotFoundError(f"nothing written to {root}")
    log = spark.read.schema(LOGGED).option("basePath", path)
    if days is None:
        return log.parquet(path)
    wanted = {f"{day:%Y-%m-%d}" for day in days}
    folders = [folder for day, folder in children(spark, path) if day in wanted]
    return log.parquet(*folders) if folders else spark.createDataFrame([], LOGGED)


def newest_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The row of every key with the greatest ``order``."""
    others = [c for c in rows.columns if c not in KEY and c not in order]
    ranked = F.struct(*order, *others)
    # The hash ends most comparisons of the long common prefixes of keys.
    newest = rows.groupBy(F.xxhash64(*KEY), *KEY).agg(F.max(ranked).alias("row"))
    return newest.select(*[c if c in KEY else F.col(f"row.{c}") for c in rows.columns])


def current(
    spark: SparkSession,
    root: str,
    tables: Sequence[str] | None = None,
    days: Sequence[date] | None = None,
) -> DataFrame:
    """The current row of every key, optionally of some tables or key days only."""
    log = changes(spark, root, days)
    if tables is not None:
        log = log.where(F.col("table_name").isin(list(tables)))
    return newest_rows(log, LATEST)

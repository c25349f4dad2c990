"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Keeps the state of open buckets outside the heap of the executors.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str, timezone: str = "UTC", hive: bool = False, **conf: object
) -> SparkSession:
    """A session with adaptive execution on and an explicit time zone.

    The zone decides the text of stored event times, so a job names it instead
    of taking the default of the machine it happens to run on. With ``hive`` the
    catalog is the metastore, so backfills find their day tables and partitions there.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", timezone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if hive:
        builder = builder.enableHiveSupport()
    for name, value in conf.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or _local_folder(spark.sparkContext.master)
    return f"{root.rstrip('/')}/gaugeflow/{label}-{uuid.uuid4().hex}"


@cache
def _local_folder(master: str) -> str:
    if not master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-")


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then read columns from the written table instead of repeating
    the work, also when executors are lost.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Output topic by the kind of monitoring."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output topics of the one-second bridge job, by configuration
# name, and the monitoring names that each gets when not configured.
BRIDGE_TOPICS = {
    "acce": ("CLLSEN-BRIDGE-HF-ACCE-HIVE", "ACCE"),
    "dyndef": ("CLLSEN-BRIDGE-HF-DYNDEF-HIVE", "DYNDEF"),
    "dispmt": ("CLLSEN-BRIDGE-HF-DISPMT-HIVE", "DISPMT"),
    "lowsumary": ("CLLSEN-BRIDGE-HF-LOWSUMRY-HIVE", "LOWSUMRY"),
    "strain": ("CLLSEN-BRIDGE-HF-STRAIN-HIVE", "STRAIN"),
}

#: Largest map that is broadcast; a longer one is joined by shuffle.
MAX_BROADCAST_ENTRIES = 100_000


def topic_map(settings: Mapping[str, str] | None = None) -> dict[str, str]:
    """Monitoring name -> topic.

    Each setting is a comma-separated list of monitoring names; several names may
    share a topic, and a name listed twice goes to the later topic.
    """
    settings = settings or {}
    return {
        name: topic
        for setting, (topic, default) in BRIDGE_TOPICS.items()
        for name in settings.get(setting, default).split(",")
    }


def with_topic(df: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """Add ``topic``; null where the monitoring name is not mapped."""
    spark = df.sparkSession
    table = spark.createDataFrame(list(topics.items()), "monitoring string, topic string")
    if len(topics) <= MAX_BROADCAST_ENTRIES:
        table = F.broadcast(table)
    return df.join(table, "monitoring", "left").select(*df.columns, "topic")

"""Hand-made readings, and the samplers written out over lists of rows."""

from __future__ import annotations

import math
import struct
from collections import defaultdict

from gaugeflow.schema import READING, READING_COLUMNS
from pyspark.sql import types as T

SCHEMA = T.StructType([*READING.fields, T.StructField("seq", T.LongType())])

BASE_TIME = 1505988755000


def reading(seq, **fields):
    row = {
        "location": "L1",
        "terminal": "T1",
        "sensor": "S1",
        "rtime": 0,
        "sensorType": "HPRESS",
        "dataType": "PV",
        "monitoring": "ACCE",
        "time": BASE_TIME,
        "level": 0,
        "values": [1.0],
        "seq": seq,
    }
    row.update(fields)
    return row


def four():
    """Four readings of one sensor within a second."""
    return [
        reading(1, time=BASE_TIME, level=1, values=[1.0, 10.0]),
        reading(2, time=BASE_TIME + 300, level=5, values=[4.0, 40.0]),
        reading(3, time=BASE_TIME + 600, level=0, values=[2.5, 20.0]),
        reading(4, time=BASE_TIME + 900, level=0, values=[0.5, 30.0]),
    ]


def frame(spark, rows, partitions=None):
    ordered = [tuple(r[c] for c in [*READING_COLUMNS, "seq"]) for r in rows]
    df = spark.createDataFrame(ordered, SCHEMA)
    return df.repartition(partitions) if partitions else df


def float32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def group_of(row, bucket_ms):
    # Truncates towards zero.
    return (row["location"], row["terminal"], row["sensor"], int(math.trunc(row["time"] / bucket_ms)))


def groups(rows, bucket_ms):
    found = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r["time"], r["rtime"], r["seq"])):
        found[group_of(row, bucket_ms)].append(row)
    return found


def earliest(rows, bucket_ms):
    return {k: g[0]["seq"] for k, g in groups(rows, bucket_ms).items()}


def last_pair(group):
    if len(group) > 1 and group[-2]["level"] > group[-1]["level"]:
        return group[-2]
    return group[-1]


def max_level(group):
    return max(group, key=lambda r: (r["level"], r["time"], r["rtime"], r["seq"]))


def stats(values):
    return [max(values), min(values), float32(sum(values) / len(values))]


def head_stats(rows, bucket_ms, pick=last_pair):
    return {
        k: (pick(g)["seq"], stats([r["values"][0] for r in g]))
        for k, g in groups(rows, bucket_ms).items()
    }


def channel_stats(rows, bucket_ms):
    out = {}
    for k, g in groups(rows, bucket_ms).items():
        rep = last_pair(g)
        flat = [s for c in range(len(rep["values"])) for s in stats([r["values"][c] for r in g])]
        out[k] = (rep["seq"], flat)
    return out


def conditional_stats(rows, bucket_ms):
    out = {}
    for k, g in groups(rows, bucket_ms).items():
        rep = last_pair(g)
        own = rep["values"]
        out[k] = (rep["seq"], stats([r["values"][0] for r in g]) if len(own) == 1 else own)
    return out


KEYS = ("location", "terminal", "sensor", "bucket")


def seqs(df):
    return {tuple(r[k] for k in KEYS): r["seq"] for r in df.collect()}


def seqs_and_values(df):
    return {tuple(r[k] for k in KEYS): (r["seq"], list(r["values"])) for r in df.collect()}

"""Centroid clustering of integer vectors, every assignment by a tournament of bisectors.

For centroids i < j, a vector x is nearer to j exactly if ``x . 2(cj - ci)`` is greater than
``|cj|^2 - |ci|^2``. The integer normals and thresholds of all pairs are made once a round. A vector
then passes k-1 sign tests, each of the winner so far against the next centroid; zero favours the
smaller number. Only the distance to the last winner is computed. All arithmetic is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import write_out

#: Components beyond this are set to it; products of 64 of them then stay within 64 bits.
BOUND = 1 << 27


def integers(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``x = floor(scale * component)`` of the vectors with ``dims`` finite components.

    Null vectors, other lengths, and vectors with a null, infinite or NaN component are left out.
    Repeated rows, and repeated or null ``vec_id``, are vectors of their own. Other columns are not read.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            whole = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
            flat = lists.filter(whole).flatten().to_numpy(zero_copy_only=False)
            x = flat.astype(np.float64).reshape(-1, dims)
            finite = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(x[finite] * scale), -BOUND, BOUND).astype(np.int32)
            names = batch.column("vec_id").filter(whole).filter(pa.array(finite))
            yield pa.RecordBatch.from_pydict({"vec_id": names, "x": _lists(x, pa.int32())})

    source = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return source.mapInArrow(kept, "vec_id long, x array<int>")


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel(), kind))


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds: ``[i, j]`` is beyond its threshold where j is nearer than i."""
    squares = (centroids**2).sum(axis=1)
    return 2 * (centroids[None] - centroids[:, None]), squares[None] - squares[:, None]


def nearest(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The number of the nearest centroid of every row of ``x``; the smaller one of equal ones."""
    winner = np.zeros(len(x), np.int64)
    for j in range(1, len(normals)):
        side = np.einsum("nd,nd->n", x, normals[winner, j])
        winner[side > thresholds[winner, j]] = j
    return winner


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims).astype(np.int64)


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``, in that order.

    A null ``vec_id`` reads ``null``; vectors of equal ids are ordered by their components.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    first = kept.select("x", F.sha2(name, 256).alias("h")).orderBy("h", "x").limit(k)
    return np.array([r["x"] for r in first.collect()], np.int64)  # k vectors


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floored mean of the vectors of every centroid; empty ones stay."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = bisectors(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = _rows(batch, dims)
            winner = nearest(x, *planes)
            count += np.bincount(winner, minlength=k)
            np.add.at(total, winner, x)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"cluster": met, "n": count[met], "total": _lists(total[met], pa.int64())}
        )

    parts = kept.mapInArrow(sums, "cluster long, n long, total array<long>")
    totals = [F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(dims)]
    moved = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():  # k rows at most
        moved[r["cluster"]] = [r[f"t{d}"] // r["n"] for d in range(dims)]
    return moved


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``: the nearest centroid and the squared distance to it."""
    dims = centroids.shape[1]

    def tournament(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = bisectors(centroids)
        for batch in batches:
            x = _rows(batch, dims)
            winner = nearest(x, *planes)
            distance = ((x - centroids[winner]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "cluster": winner.astype(np.int32),
                    "distance": distance,
                }
            )

    return kept.mapInArrow(tournament, "vec_id long, cluster int, distance long")


def _described(spark: SparkSession, rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per cluster that has vectors: its inertia, that of all, the digest of its centroid."""
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r["cluster"]: int(r["s"]) for r in sums.collect()}  # k rows at most
    most, whole = 2**63 - 1, sum(inertia.values())
    described = [
        (k, min(s, most), min(whole, most), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, s in inertia.items()
        for c in [centroids[k].tolist()]
    ]
    return spark.createDataFrame(
        described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )


def clusters(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2",
    dims: int = 64,
    scale: int = 256,
) -> DataFrame:
    """Cluster the vectors that :func:`integers` keeps, one row each.

    ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``. The centroids start as
    ``k`` of the vectors, or as all of them if there are fewer; equal starts leave the later ones
    empty. Without a vector the result is empty. Inertias beyond 64 bits are the greatest long.
    """
    spark = vectors.sparkSession
    kept = write_out(integers(vectors, dims, scale), "integer-vectors")
    centroids = first_centroids(kept, k, seed).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(kept, centroids)
    rows = write_out(assigned(kept, centroids), "assigned")
    return rows.join(F.broadcast(_described(spark, rows, centroids)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

"""Centroid clustering of integer vectors by a tournament of bisectors.

Whether a vector is nearer to centroid a or to b is the side of one hyperplane it lies on. Normal and
threshold of every pair's bisector are integers and computed once a round; a vector then meets
the centroids one after the other, and each sign test eliminates one of two. On the plane
itself the smaller number stays. Only the winner's distance is computed.

All numbers are exact: a batch is worked in floats while no product sum can pass 2^53, in 64-bit integers
up to 2^62, and beyond in integers of any size. Each task gives the sums of its part as digits of
2^40, which Spark adds up, so a round shuffles a few rows for each task, whatever the sizes of clusters.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import discard, stored

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
_PLACE = 40  # bits of a digit
_LONG = 1 << 63


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = SIZE) -> DataFrame:
    """(id, x) of the vectors with exactly ``size`` components, none null or non-finite."""
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x")).where(F.size("x") == size)
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(~bad)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 x), exact: as floats where these hold it, else as Python's integers."""
    if not x.size or np.abs(x).max() < 2.0 ** 40:
        return np.floor(x * SCALE)
    return np.array([[math.floor(v * SCALE) if abs(v) < 2.0 ** 900 else int(v) * SCALE for v in row] for row in x.tolist()], object)


class Bisectors:
    """Normals and thresholds of all pairs of centroids, as Python's integers."""

    def __init__(self, centroids: list[list[int]]):
        k = len(centroids)
        size = len(centroids[0]) if k else 0
        self.centroids = np.array(centroids, object).reshape(k, size)
        squares = [sum(v * v for v in c) for c in centroids]
        self.normals = np.array([[[2 * (q - p) for p, q in zip(a, b, strict=True)] for b in centroids] for a in centroids], object).reshape(k, k, size)
        self.thresholds = np.array([[squares[b] - squares[a] for b in range(k)] for a in range(k)], object)
        self.most = max([1, *(abs(int(v)) for v in self.normals.flat), *(abs(int(v)) for v in self.centroids.flat)])

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest centroid and its squared distance to it."""
        largest = int(np.abs(x).max()) if x.size else 0
        bound = 4 * (largest + self.most) ** 2 * max(1, x.shape[1])  # over every product sum and threshold met
        kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
        if kind is object and x.dtype != object:
            x = np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
        x, normals, thresholds, centroids = (v.astype(kind) for v in (x, self.normals, self.thresholds, self.centroids))
        best = np.zeros(len(x), np.int64)
        for rival in range(1, len(centroids)):
            beyond = (x * normals[best, rival]).sum(axis=1) > thresholds[best, rival]
            best[beyond.astype(bool)] = rival
        gap = x - centroids[best]
        return best, (gap * gap).sum(axis=1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def first_centroids(rows: DataFrame, count: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; of equal ids the smallest vector first, null ids last."""
    order = [F.col("h").asc_nulls_last(), F.col("x")]
    top = rows.withColumn("h", F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")), 256)).orderBy(*order).limit(count).collect()
    return [[int(v) for v in integers(np.array([r["x"]]))[0].tolist()] for r in top]


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Means of the clusters, rounded down; a centroid without vectors stays."""
    shared = rows.sparkSession.sparkContext.broadcast(Bisectors(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for _, x in _batches(batches):
            x = integers(x)
            best, _ = shared.value.assign(x)
            for c in np.unique(best).tolist():
                part = x[best == c]
                if part.dtype != object:  # 2^22 rows below 2^40 fit 64 bits
                    part = part.astype(np.int64)
                    whole = part if np.abs(part).max() < 1 << 40 and len(part) < 1 << 22 else part.astype(object)
                else:
                    whole = part
                added = [int(v) for v in whole.sum(axis=0).tolist()]
                sums[c] = [a + b for a, b in zip(sums.get(c, [0] * len(added)), added, strict=True)]
                counts[c] = counts.get(c, 0) + len(part)
        out = [(c, -1, 0, n) for c, n in counts.items()]
        for c, values in sums.items():
            for d, v in enumerate(values):
                place = 0
                while True:
                    if -(1 << _PLACE) < v < 1 << _PLACE:
                        out.append((c, d, place, v))
                        break
                    out.append((c, d, place, v & (1 << _PLACE) - 1))
                    v >>= _PLACE
                    place += 1
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["c", "d", "place", "v"])

    parts = rows.select("x").mapInArrow(run, "c int, d int, place int, v bigint").groupBy("c", "d", "place").agg(F.sum("v").alias("v"))
    sums: dict[tuple[int, int], int] = {}
    for r in parts.collect():  # clusters x components x places
        sums[r["c"], r["d"]] = sums.get((r["c"], r["d"]), 0) + (r["v"] << _PLACE * r["place"])
    return [[sums[c, d] // sums[c, -1] for d in range(len(old))] if (c, -1) in sums else old for c, old in enumerate(centroids)]


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of (id, x); a distance too large for a long is null."""
    shared = rows.sparkSession.sparkContext.broadcast(Bisectors(centroids))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _batches(batches):
            best, far = shared.value.assign(integers(x))
            far = pa.array([int(v) if v < _LONG else None for v in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best.astype(np.int32)), far], names=["id", "cluster", "distance"])

    return rows.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS,
            rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every kept vector, the final centroids).

    Vectors that are null, of another size, or that hold a null or non-finite component are left out.
    Repeated rows and ids are vectors of their own. With fewer vectors than ``clusters`` each of them
    starts one; an empty table gives no rows and no centroids. Components of any size are exact. Other
    columns are not read.
    """
    rows = stored(usable(vectors, key, vector, size), "centroid-vectors")
    centroids = first_centroids(rows, clusters)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    out = stored(assigned(rows, centroids), "centroid-clusters")
    discard(rows)
    return out, centroids


def report(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector. Sums
    that a long cannot hold, or that have a distance of that kind, are null."""
    rows, centroids = cluster(vectors, **options)
    spark = rows.sparkSession
    found = {r["cluster"]: r for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n"), F.count("distance").alias("known")).collect()}
    totals = {c: int(r["total"]) if r["n"] == r["known"] else None for c, r in found.items()}
    whole = None if None in totals.values() else sum(totals.values())
    fits = lambda v: v if v is not None and v < _LONG else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    table = spark.createDataFrame([(c, fits(v), fits(whole), digest[c]) for c, v in totals.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.withColumnRenamed("id", "vec_id").join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

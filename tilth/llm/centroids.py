"""Centroid clustering in exact integers, by a tournament of bisecting planes.

For a pair of centroids i < j the sign of 2 (c_j - c_i) x - (|c_j|^2 - |c_i|^2) tells which
is nearer; zero means equally near, and the smaller number stays. Normals and thresholds of
all pairs are worked out once a round; k - 1 sign tests then leave one centroid for each
vector, and only its distance is computed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, written

#: Integers of a larger size are no longs with room for a difference; 2^62 / 64 is far above any embedding.
LARGEST = 1 << 62
ROWS = 8192


def planes(centroids: list[list[int]], exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(normals, thresholds) by pair: x is as near to i as to j, or nearer, if normals[i, j] x <= thresholds[i, j]."""
    c = np.array(centroids, object if exact else np.int64)
    squares = (c * c).sum(axis=1)
    return 2 * (c[None, :, :] - c[:, None, :]), squares[None, :] - squares[:, None]


def tournament(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row; of equally near ones the smallest."""
    best = np.zeros(len(x), np.int64)
    for j in range(1, len(normals)):
        side = (x * normals[best, j]).sum(axis=1) - thresholds[best, j]
        best[side > 0] = j
    return best


class Rounds:
    """Assigns batches of vectors; 64-bit integers where no product can overflow, unbounded ones elsewhere."""

    def __init__(self, centroids: list[list[int]], scale: int):
        self.scale = scale
        self.small = math.isqrt((1 << 63) // (5 * len(centroids[0])))
        self.plain = max(abs(v) for c in centroids for v in c) <= self.small
        self.kinds = {exact: (*planes(centroids, exact), np.array(centroids, object if exact else np.int64)) for exact in ([True, False] if self.plain else [True])}

    def assign(self, column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(integer components, nearest centroid) of each vector."""
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        x = np.floor(values.astype(np.float64) * self.scale).astype(np.int64)
        if not self.plain or (len(x) and max(int(x.max()), -int(x.min())) > self.small):
            x = x.astype(object)
        normals, thresholds, _ = self.kinds[x.dtype == object]
        return x, tournament(x, normals, thresholds)

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        step = x - self.kinds[x.dtype == object][2][best]
        return (step * step).sum(axis=1)


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for at in range(0, part.num_rows, ROWS):
            yield part.slice(at, ROWS)


def kept_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec double[]) of the rows whose vector has ``dims`` finite components."""
    rows = pick(vectors, vec_id=id_col, vec=vec_col).select("vec_id", F.col("vec").cast("array<double>").alias("vec"))
    # NaN compares as larger than any number
    sound = (F.size("vec") == dims) & ~F.exists("vec", lambda x: x.isNull() | ~(F.abs(x * scale) < float(LARGEST)))
    return rows.where(sound)


def first_centroids(kept: DataFrame, k: int, scale: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id``, in that order; equal ids in order of their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    whole = F.transform("vec", lambda x: F.floor(x * scale))
    return [list(r["c"]) for r in kept.select(key.alias("h"), whole.alias("c")).orderBy("h", "c").limit(k).collect()]


def next_centroids(kept: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Each centroid's vectors' floored mean, itself where it has none; a row per task and centroid is shuffled."""
    dims = len(centroids[0])

    def totals(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(centroids, scale)
        sums, counts = np.zeros((len(centroids), dims), object), np.zeros(len(centroids), np.int64)
        for part in _slices(parts):
            x, best = rounds.assign(part.column(0))
            for c in np.unique(best).tolist():
                own = x[best == c]
                # a slice of small integers can't overflow, larger ones come as objects
                sums[c] += own.sum(axis=0).astype(object)
                counts[c] += len(own)
        used = np.flatnonzero(counts)
        kind = pa.list_(pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64()), pa.array([[Decimal(v) for v in sums[c]] for c in used], kind)], names=["cluster", "n", "sums"]
        )

    partial = kept.select("vec").mapInArrow(totals, "cluster long, n long, sums array<decimal(38,0)>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
    moved = list(centroids)
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return moved


def clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1", id_col: str = "vec_id", vec_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` moves of k centroids and a last assignment; runs jobs.

    Components become floor(scale * x). Left out are rows without an id, vectors of another
    length, and those with a null, non-finite or unrepresentable component (2^62 and more
    after scaling). Repeated rows are vectors of their own. With fewer than k vectors each
    is a centroid; with none there are no rows. Of equally near centroids the smaller number
    wins. distance is squared, and null where no long holds it; the assignment is exact
    there too. Every round scans the vectors once; tasks get k * k * dims numbers and send
    k rows, so k is to be small.
    """
    kept = kept_vectors(vectors, dims, scale, id_col, vec_col)
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(kept, k, scale, seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), []
    for _ in range(rounds):
        centroids = next_centroids(kept, centroids, scale)
    last = centroids

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Rounds(last, scale)
        for part in _slices(parts):
            x, best = own.assign(part.column(1))
            far = own.distances(x, best)
            held = [v if v < 1 << 63 else None for v in far.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.int32()), pa.array(held, pa.int64())], names=["vec_id", "cluster", "distance"])

    return kept.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), last


def cluster_report(vectors: DataFrame, **settings) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector; runs jobs.

    As ``clusters``, with the distances summed over each cluster and over all: null where
    one of them is null or no long holds the sum.
    """
    found, centroids = clusters(vectors, **settings)
    found = written(found, "assigned")
    whole = F.expr("case when count(distance) = count(*) then try_cast(sum(cast(distance as decimal(38,0))) as bigint) end")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(whole.alias("s")).collect()}
    total = None if None in sums.values() else sum(sums.values())
    total = total if total is not None and total < 1 << 63 else None
    rows = [(i, sums[i], total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids) if i in sums]
    own = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(own, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""Centroid clustering of integer vectors, with distances to fixed pivots sparing most exact distances.

A pivot is a vector that stays the same in all rounds. The distances of every vector to all pivots
are worked out once and stored beside it. In a round only the few centroids are measured against the
pivots; by the triangle inequality the difference of two distances to the same pivot is at most the
distance of the two vectors, so the largest difference over the pivots is a lower bound for each
centroid. A vector is first compared with the centroid of the lowest bound, then with those whose
bound does not exceed the best distance so far. Distances that decide anything are exact integers;
bounds are floating-point numbers and get ``SLACK``, more than their rounding error.

The first centroids are the vectors of the smallest salted hashes of their ids. A round sends sums of
its vectors, one row per task and cluster, through a partial aggregation; the new centroids are the
exact floors of the means. Each round reads the stored table, so a lost executor costs a task.

Defined cases: vectors that are null, of another length, or with a null, infinite or NaN component
are left out. With fewer vectors than centroids each vector starts one; an empty table gives no
rows. Ties in distance go to the smaller number. Null ids start a centroid only after all others;
of equal ids the smaller vector goes first. Repeated rows count each. An empty cluster keeps its
centroid. A component of 2^27 or more after scaling raises an error, as squared distances would not
fit a long. Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import by_value, written

by_value(__name__)

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, PIVOTS = 64, 1024, 8, 10, 8
#: Vectors that pivots are chosen from, by a hash of their ids.
CANDIDATES = 128
#: Scaled components are smaller than this in magnitude.
LARGEST = 1 << 27
#: Share by which a lower bound is taken smaller than computed.
SLACK = 1e-9


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, embedding) of the vectors with exactly ``dimensions`` finite components, as doubles."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
            .filter((F.size("embedding") == dimensions) & whole))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(scale * values)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"a component of {np.abs(values).max()} is too large: scaled by {scale} it has to stay below {LARGEST}")
    return scaled.astype(np.int64)


def first_by_hash(points: DataFrame, salt: str, count: int, dimensions: int, scale: int) -> np.ndarray:
    """The ``count`` vectors of the smallest ``sha256(salt:vec_id)``, in that order: at most ``count`` rows per task travel."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select("embedding", key.alias("key")).orderBy(F.asc_nulls_last("key"), "embedding").limit(count).collect()
    return integers(np.array([r["embedding"] for r in rows], float).reshape(len(rows), dimensions), scale)


def spread(candidates: np.ndarray, count: int) -> np.ndarray:
    """``count`` pivots: the first candidate, then always the one farthest from its nearest pivot."""
    chosen = [0] if len(candidates) else []
    near = square_distances(candidates, candidates[0]) if chosen else np.zeros(0, np.int64)
    while len(chosen) < count and near.size and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, square_distances(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def square_distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all points to all pivots."""
    return np.sqrt(np.stack([square_distances(points, p) for p in pivots], axis=1).astype(float)) if len(pivots) else np.zeros((len(points), 0))


def nearest(points: np.ndarray, pivot_distances: np.ndarray, centres: np.ndarray, centre_distances: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre and squared distance of every point, and how many exact distances that took."""
    bounds = np.zeros((len(points), len(centres)))
    for p in range(pivot_distances.shape[1]):
        np.maximum(bounds, np.abs(pivot_distances[:, p, None] - centre_distances[None, :, p]), out=bounds)
    largest = max(pivot_distances.max(initial=0.0), centre_distances.max(initial=0.0))
    bounds = np.maximum(bounds - SLACK * (largest + 1), 0.0) ** 2 * (1 - SLACK)
    start = bounds.argmin(axis=1)
    cluster, best, exact = start.copy(), np.empty(len(points), np.int64), len(points)
    for c, centre in enumerate(centres):
        mine = np.flatnonzero(start == c)
        best[mine] = square_distances(points[mine], centre)
    for c, centre in enumerate(centres):
        open_ = np.flatnonzero((start != c) & (bounds[:, c] <= best))
        distance = square_distances(points[open_], centre)
        closer = (distance < best[open_]) | ((distance == best[open_]) & (c < cluster[open_]))
        cluster[open_[closer]], best[open_[closer]] = c, distance[closer]
        exact += len(open_)
    return cluster, best, exact


@dataclass
class Clustering:
    """Vectors with their clusters, the final centroids, and the distances summed per cluster."""

    members: DataFrame
    centroids: list[list[int]]
    sums: list[int]


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def unpacked(batch: pa.RecordBatch, dimensions: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(b"".join(batch["components"].to_pylist()), np.int32).reshape(batch.num_rows, dimensions).astype(np.int64)
    return points, np.frombuffer(b"".join(batch["pivots"].to_pylist()), np.float64).reshape(batch.num_rows, pivots)


def clustered(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
              scale: int = SCALE, salt: str = "3", pivots: int = PIVOTS) -> Clustering:
    """Lloyd's rounds over (vec_id, embedding); members are (vec_id, cluster, distance)."""
    points = kept(vectors, dimensions)
    centres = first_by_hash(points, salt, centroids, dimensions, scale)
    fixed = spread(first_by_hash(points, "pivot", CANDIDATES, dimensions, scale), pivots)
    kind = points.schema["vec_id"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch["embedding"].flatten().to_numpy().reshape(batch.num_rows, dimensions), scale)
            yield pa.record_batch([batch["vec_id"], packed(whole.astype(np.int32)), packed(to_pivots(whole, fixed))], ["vec_id", "components", "pivots"])

    stored = written(points.mapInArrow(measured, f"vec_id {kind}, components binary, pivots binary"), "pivot-table")

    for _ in range(rounds if len(centres) else 0):
        centres = means(stored, centres, fixed)
    found = to_pivots(centres, fixed)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = nearest(*unpacked(batch, dimensions, len(fixed)), centres, found)
            yield pa.record_batch([batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    members = written(stored.mapInArrow(assigned, f"vec_id {kind}, cluster int, distance long"), "clusters")
    sums = dict(members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    return Clustering(members, centres.tolist(), [int(sums.get(c, 0)) for c in range(len(centres))])


def means(stored: DataFrame, centres: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means of the vectors nearest to each of ``centres``."""
    dimensions, found = centres.shape[1], to_pivots(centres, fixed)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
        for batch in batches:
            points, distances = unpacked(batch, dimensions, len(fixed))
            cluster, _, _ = nearest(points, distances, centres, found)
            for c in range(len(centres)):
                sums[c] += points[cluster == c].sum(axis=0)
            counts += np.bincount(cluster, minlength=len(centres))
        used = np.flatnonzero(counts)
        if len(used):  # one row per component, and one for the number of vectors
            yield pa.record_batch([pa.array(np.repeat(used, dimensions + 1), pa.int32()), pa.array(np.tile(np.arange(dimensions + 1), len(used)), pa.int32()),
                                   pa.array(np.column_stack([sums[used], counts[used]]).ravel())], ["cluster", "place", "total"])

    parts = stored.mapInArrow(summed, "cluster int, place int, total long")
    totals: dict[int, dict[int, int]] = {}
    for cluster, place, total in parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        totals.setdefault(cluster, {})[place] = int(total)
    centres = centres.copy()
    for cluster, found_sums in totals.items():
        centres[cluster] = [found_sums[i] // found_sums[dimensions] for i in range(dimensions)]
    return centres


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster and distance of every kept vector, with its cluster's and the total inertia and its centroid's digest."""
    result = clustered(vectors)

    def of_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in result.centroids]
    return result.members.select("vec_id", "cluster", "distance", of_cluster(result.sums, "bigint").alias("cluster_inertia"),
                                 F.lit(sum(result.sums)).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))

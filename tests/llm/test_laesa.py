"""Clustering against plain rounds over all exact distances."""

import hashlib

import numpy as np
import pytest

from gearwatch.llm import laesa

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int"


def plain(rows, count=8, rounds=10, dimensions=64):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(column) // len(groups[k]) for column in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {k: sum(d for _, c, d in found if c == k) for k in range(len(centres))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in found), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def vectors(count, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 64)) * spread
    return [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(size=64)]) for i in range(count)]


@pytest.mark.parametrize("rows", [
    vectors(150, 1), vectors(60, 2, 30.0), vectors(5, 3),
    [(i, [float(i % 3)] * 64) for i in range(40)],  # ties and empty clusters
    vectors(40, 4) * 2 + [(None, [0.5] * 64), (None, [0.25] * 64), (7, [-0.125] * 64), (2**62, [1.0] * 64), (-2**62 - 1, [1.0] * 64)],
], ids=["noise", "clear", "fewer than centroids", "ties", "repeated and null ids"])
def test_equals_plain_rounds(spark, rows):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(5)
    assert got(laesa.report(df)) == plain(rows)


def test_odd_vectors_are_left_out(spark):
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [1.0] * 63 + [None]), (105, [1.0] * 63 + [float("nan")]), (106, [float("-inf")] + [1.0] * 63)]
    rows = vectors(20, 5) + odd
    assert got(laesa.report(spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(40))) == plain(rows)
    empty = laesa.report(spark.createDataFrame([(i, v, 0, 0) for i, v in odd], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert laesa.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        laesa.report(spark.createDataFrame([(1, [1e6] * 64, 0, 0)], SCHEMA))


def test_pivots_spare_exact_distances():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 64)) * 8
    points = np.floor(1024 * (centres[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 64)))).astype(np.int64)
    whole, pivots = np.floor(1024 * centres).astype(np.int64), laesa.spread(points[:64], 8)
    cluster, best, exact = laesa.nearest(points, laesa.to_pivots(points, pivots), whole, laesa.to_pivots(whole, pivots))
    every = np.stack([laesa.square_distances(points, c) for c in whole], axis=1)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert exact < 0.5 * every.size

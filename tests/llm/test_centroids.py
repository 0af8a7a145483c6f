import hashlib
import math

import numpy as np
import pytest

from tilth.llm.centroids import cluster_report, clusters, planes, tournament

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance double"


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    """(vec_id, cluster, distance) and centroids with Python integers and all distances."""
    kept = []
    for i, v in rows:
        if i is None or v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(scale * x) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for j, vs in own.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 1.0) for i, v in rows], SCHEMA)


def check(spark, rows, **settings):
    want, centroids = plain(rows, **settings)
    got = cluster_report(frame(spark, rows), **settings).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(want)
    total = sum(d for _, _, d in want)
    for r in got:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
    return want


def test_matches_all_distances_with_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) * 0.2).tolist()) for i in range(400)]
    rows += [(400, None), (401, []), (402, [0.1] * 63), (403, [0.1] * 63 + [None]), (404, [0.1] * 63 + [math.nan]), (405, [math.inf] * 64), (406, [0.0] * 64)]
    rows += [(407, [-0.001] * 64), (None, [0.1] * 64), (7, rows[7][1]), (8, rows[9][1])]
    assert len(check(spark, rows)) == 404


def test_ties_go_to_the_smaller_number(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) / 64 for x in rng.integers(0, 2, 4)]) for i in range(300)]
    check(spark, rows, k=6, dims=4)
    x = rng.integers(-3, 4, (500, 5))
    c = rng.integers(-3, 4, (7, 5))
    far = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (tournament(x, *planes(c.tolist(), False)) == far.argmin(axis=1)).all()


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) * 1e6).tolist()) for i in range(20)]
    check(spark, rows, k=5)  # above what 64-bit products hold, below what a long can't name
    rows += [(100, [2.0**55] * 64), (101, [-(2.0**55)] * 64), (102, [2.0**57] * 64)]
    got = {r["vec_id"]: r for r in clusters(frame(spark, rows), k=5)[0].collect()}
    want = {i: (c, d) for i, c, d in plain(rows[:-1], k=5)[0]}
    assert set(got) == set(want)
    assert {i: (r["cluster"], r["distance"]) for i, r in got.items()} == {i: (c, d if d < 1 << 63 else None) for i, (c, d) in want.items()}


@pytest.mark.parametrize("n", [0, 5])
def test_few_vectors(spark, n):
    rows = [(i, [i / 64] * 64) for i in range(n)]
    want = check(spark, rows)
    assert all(d == 0 for _, _, d in want)
    same = [(i, [0.5] * 64) for i in range(20)]
    assert {c for _, c, _ in check(spark, same)} == {0}

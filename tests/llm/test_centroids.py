"""Centroid clustering against a direct restatement on made vectors."""
import hashlib
import math
import random

import numpy as np
import pytest

from csvforge.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, v string, near string, cluster string"


def vectors(n=300, seed=8):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    out = [(i, [float(np.float32(x + rnd.gauss(0, 0.2))) for x in rnd.choice(middles)]) for i in range(n)]
    out += [(i + n, list(out[7][1])) for i in range(30)]                  # copies of one vector
    out += [out[3], out[3], (out[4][0], [0.5] * 64), (None, [0.25] * 64)]   # repeated rows and ids, a null id
    out += [(900, None), (901, []), (902, [0.1] * 63), (903, [0.1] * 65), (904, [None] + [0.1] * 63),
            (905, [math.nan] + [0.1] * 63), (906, [math.inf] + [0.1] * 63)]
    return [(i, v, 1, "x", "y", "z") for i, v in out]


def brute(rows, k=40, rounds=5):
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [list(v) for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, got) if c == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    last = assign()
    return [(i, j, d) for (i, _), (d, j) in zip(kept, last)], cents


def test_clusters_equal_brute_force(spark):
    rows = vectors()
    want, cents = brute(rows)
    got, made = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert made.tolist() == cents


def test_query_columns(spark, tmp):
    rows = vectors(60)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp}/embeddings.parquet")
    want, cents = brute(rows)
    got = centroids.op11_centroid_clustering(spark, tmp).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, j, d in want if j == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark, tmp):
    few = spark.createDataFrame([(1, [0.1] * 64), (2, [0.2] * 64)], "vec_id long, embedding array<float>")
    got, cents = centroids.cluster_vectors(few)
    assert len(cents) == 2 and sorted(r.distance for r in got.collect()) == [0, 0]
    few.where("vec_id > 5").write.parquet(f"{tmp}/embeddings.parquet")
    out = centroids.op11_centroid_clustering(spark, tmp)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_pivots_spare_distances_and_lose_nothing():
    rnd = np.random.default_rng(4)
    cents = rnd.integers(-900, 900, (40, 64))
    v = cents[rnd.integers(0, 40, 2000)] + rnd.integers(-40, 40, (2000, 64))
    v[:50] = (cents[:50 % 40 + 1].mean(axis=0)).astype(np.int64)             # ties and middles
    pivots = centroids.choose_pivots(cents, 12)
    who, best, n = centroids.nearest(v, centroids.pivot_distances(v, pivots), cents, centroids.pivot_distances(cents, pivots))
    full = np.stack([centroids.squares(v, c) for c in cents], axis=1)
    assert (who == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert n < 0.5 * full.size


def test_components_too_large_stop_the_job(spark):
    with pytest.raises(Exception, match="too large in vector 7"):
        centroids.cluster_vectors(spark.createDataFrame([(7, [1e30] * 64)], "vec_id long, embedding array<float>"))

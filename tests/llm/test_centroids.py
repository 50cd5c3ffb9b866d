"""Centroid clustering against plain integers, odd rows included."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from fleetquarry.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v int"


def plain_clusters(rows, count=40, rounds=5):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == 64 and all(e is not None and math.isfinite(e) for e in x):
            kept.append((vec_id, tuple(math.floor(256 * float(np.float32(e))) for e in x)))

    def mark(row):
        return (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])

    middles = [v for _, v in sorted(kept, key=mark)[:count]]

    def assign():
        near = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in middles]
            near.append((far.index(min(far)), min(far)))
        return near

    for _ in range(rounds):
        near = assign()
        for k in range(len(middles)):
            own = [v for (_, v), (c, _) in zip(kept, near) if c == k]
            if own:
                middles[k] = tuple(sum(d) // len(own) for d in zip(*own))
    near = assign()
    totals = {}
    for c, d in near:
        totals[c] = totals.get(c, 0) + d
    whole = sum(totals.values())
    return [
        (i, c, d, totals[c], whole, hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, near)
    ]


def written(spark, tmp_path, rows):
    spark.createDataFrame([(i, x, 1, "x", 2) for i, x in rows], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_every_vector_against_plain_integers(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.2) + (i % 5) for _ in range(64)]) for i in range(150)]
    rows += [(200, None), (201, [0.0] * 63), (202, [0.0] * 65), (203, [0.0] * 63 + [None]), (204, [float("nan")] + [0.0] * 63)]
    rows += [(205, [float("inf")] + [0.0] * 63), (206, [0.0] * 64), (None, [0.5] * 64), (None, [0.5] * 64), (7, rows[7][1]), (8, [1.0] * 64)]
    rows += [(300 + i, [0.25] * 64) for i in range(30)]  # ties and repeats
    got = [tuple(r) for r in queries.op13_centroids(spark, written(spark, tmp_path, rows)).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows), key=str)


def test_fewer_vectors_than_centroids(spark, tmp_path):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    got = sorted(tuple(r) for r in queries.op13_centroids(spark, written(spark, tmp_path, rows)).collect())
    assert got == sorted(plain_clusters(rows)) and {r[2] for r in got} == {0}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0])]])
def test_no_usable_vectors(spark, tmp_path, rows):
    assert queries.op13_centroids(spark, written(spark, tmp_path, rows)).collect() == []


def test_a_component_too_large_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="a component beyond"):
        queries.op13_centroids(spark, written(spark, tmp_path, [(1, [1e30] * 64)])).collect()


def test_tables_give_the_distances():
    rng = np.random.default_rng(1)
    v, c = rng.integers(-300, 300, (50, 6)), rng.integers(-300, 300, (7, 6))
    assert (centroids.distances(v, c) == ((v[:, None] - c[None]) ** 2).sum(axis=2)).all()

"""Heap-ordered clustering against scanning every vector in every round."""

import hashlib
import math
import random

import numpy as np
import pytest
from tessera.llm import heapmeans as hm

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, clusters, rounds, dims, seed=hm.SEED, scale=hm.SCALE):
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x * scale) <= hm.LIMIT for x in v)]
    by_hash = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in by_hash[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                centres[k] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [(i, nearest(v)) for i, v in kept]
    sums = {}
    for _, (d, k) in final:
        sums[k] = sums.get(k, 0) + d
    return sorted(((i, k, d, sums[k], sum(sums.values()), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest())
                   for i, (d, k) in final), key=repr)


def vectors(n, dims, seed=5):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.25) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, [0.5] * dims) for i in range(n // 2)]                       # a common vector
    rows += [(2 * n, rows[0][1]), (2 * n, rows[0][1]), (None, rows[1][1]), (None, [0.25] * dims)]
    rows += [(3 * n, None), (3 * n + 1, []), (3 * n + 2, [0.1] * (dims - 1)), (3 * n + 3, [None] + [0.1] * (dims - 1)),
             (3 * n + 4, [float("nan")] * dims), (3 * n + 5, [float("inf")] * dims), (3 * n + 6, [1e30] * dims)]
    return rows


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    found = hm.cluster_vectors(df, **options)
    return sorted((tuple(r) for r in hm.with_inertia(found).collect()), key=repr), found


@pytest.mark.parametrize("clusters,rounds", [(5, 6), (1, 3), (8, 0)])
def test_same_as_scanning_everything(spark, clusters, rounds):
    rows = vectors(120, 4)
    got, found = result(spark, rows, clusters=clusters, rounds=rounds, dims=4)
    assert got == brute(rows, clusters, rounds, 4)
    assert found.scanned[0] == len(got)


def test_only_expired_gaps_are_scanned(spark):
    rows = vectors(1500, 4)
    got, found = result(spark, rows, clusters=6, rounds=8, dims=4)
    assert got == brute(rows, 6, 8, 4)
    assert len(found.scanned) > 3 and sum(found.scanned[1:]) < 0.6 * found.scanned[0] * (len(found.scanned) - 1)


def test_equal_distances_go_to_the_smaller_number(spark):
    grid = [(i, [float(i % 5), float(i // 5 % 5)]) for i in range(75)]           # many ties, repeated vectors
    got, _ = result(spark, grid, clusters=7, rounds=5, dims=2, scale=2)
    assert got == brute(grid, 7, 5, 2, scale=2)


def test_few_and_no_vectors(spark):
    few = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.75, 1.0])]
    assert result(spark, few, clusters=8, rounds=4, dims=2)[0] == brute(few, 8, 4, 2)
    assert result(spark, [], clusters=8, rounds=4, dims=2)[0] == []
    assert result(spark, [(1, None)], clusters=8, rounds=4, dims=2)[0] == []


def test_gap_of_two_centroids():
    best, gap = hm.nearest(np.array([[0, 0], [3, 4]]), np.array([[0, 0], [6, 8]]))
    assert best.tolist() == [0, 0] and gap[0] == pytest.approx(10) and gap[1] <= 0


def test_columns_of_clashing_names(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], "a", "b"), (2, [0.1, 0.5], "c", "d")], "`my id` long, x array<float>, cluster string, `key.v` string")
    found = hm.cluster_vectors(df, "my id", "x", clusters=2, rounds=2, dims=2)
    assert found.rows.columns == ["vec_id", "cluster", "distance"] and found.rows.count() == 2

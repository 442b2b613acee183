from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tallymark.llm import lloyd

from tests.llm.samples import frame

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for i, v, _ in rows:
        if v is None or len(v) != dims or any(x is None or not math.isfinite(x) or abs(x) > lloyd.LARGEST for x in v):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    chosen = sorted(kept, key=lambda p: (hashlib.sha256(f"1:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    centers = [v for _, v in chosen[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centers[j] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(centers))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found), key=repr)


def found(spark, rows, **options):
    return sorted(map(tuple, lloyd.clustered(frame(spark, rows, SCHEMA).repartition(5), **options).collect()), key=repr)


def vectors(n, dims=64, spread=0.2, seed=0):
    pick = np.random.default_rng(seed)
    middles = pick.standard_normal((5, dims))
    return [(i, (middles[i % 5] + spread * pick.standard_normal(dims)).astype(np.float32).tolist(), 1) for i in range(n)]


def ones(i, value, dims=64):
    return (i, [value] * dims, None)


ODD = [
    ones(900, 0.0),
    ones(901, 0.0),
    ones(901, 0.0),
    ones(901, 1.0),
    ones(902, -1.015625),
    ones(None, 0.5),
    ones(None, -0.5),
    (903, None, 1),
    (904, [], 1),
    ones(905, 1.0, 63),
    ones(906, 1.0, 65),
    (907, [None] + [1.0] * 63, 1),
    (908, [float("nan")] + [1.0] * 63, 1),
    (909, [float("-inf")] + [1.0] * 63, 1),
    (910, [3e38] + [1.0] * 63, 1),
    (911, [2097152.0] + [-2097152.0] * 63, 1),
    (912, [700.5] + [-3.25] * 63, 1),
]


def test_same_as_brute_force(spark):
    rows = vectors(300) + ODD
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("chunk, shard", [(7, 64), (50, 10), (1, 1)])
def test_chunks_and_shards_of_any_size(spark, monkeypatch, chunk, shard):
    monkeypatch.setattr(lloyd, "CHUNK", chunk)
    monkeypatch.setattr(lloyd, "SHARD", shard)
    rows = vectors(60, 12) + [ones(100 + i, i / 7, 12) for i in range(9)]
    assert found(spark, rows, k=4, dims=12) == expected(rows, k=4, dims=12)


def test_equal_vectors_ties_and_empty_clusters(spark):
    rows = [ones(i, float(i % 2)) for i in range(200)] + [ones(7, 1.0)] * 50
    assert found(spark, rows, k=5) == expected(rows, k=5)
    assert found(spark, rows, k=5, rounds=0) == expected(rows, k=5, rounds=0)


def test_few_and_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1)]) == []
    rows = vectors(3)
    assert found(spark, rows) == expected(rows)


def test_slices_are_not_moved_again(spark):
    points = lloyd._points(frame(spark, vectors(50), SCHEMA), 64, 64)
    sharded = lloyd._Sharded(points, 64)
    try:
        slices = spark.table(sharded._name)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sent = slices.groupBy("chunk", "shard").count()
        plan = slices.hint("merge").join(sent, ["chunk", "shard"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        sharded.forget()

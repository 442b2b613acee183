from __future__ import annotations

import math

import numpy as np
import pytest

from tallymark.llm import cover_tree

from tests.llm.samples import frame

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, least=0.93):
    fine = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float32).astype(float)
        fine.append((at, i, label, v))
    links = {i: 0 for i, _, _ in rows}
    parent = {i: i for i, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, i, la, x in fine:
        for b, j, lb, y in fine:
            if a != b and la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                if i != j:
                    p, q = root(i), root(j)
                    parent[max(p, q)] = min(p, q)
    return sorted(((i, links[i], root(i)) for i, _, _ in rows), key=repr)


def clusters(seed, n, dims=12, centers=6, noise=0.12):
    pick = np.random.default_rng(seed)
    middle = pick.standard_normal((centers, dims))
    which = pick.integers(0, centers, n)
    points = middle[which] + noise * pick.standard_normal((n, dims))
    return [(int(i), points[i].astype(np.float32).tolist(), int(pick.integers(0, 2))) for i in pick.permutation(n)]


ODD = [
    (1001, [1.0, 0.0], 0),
    (1002, [2.0, 0.0], 0),
    (1000, [1.0, 0.0], 0),
    (1003, [1.0, 0.0], 1),
    (1004, [1.0, 0.0, 0.0], 0),
    (1005, [0.0, 0.0], 0),
    (1006, None, 0),
    (1007, [], 0),
    (1008, [float("nan"), 1.0], 0),
    (1009, [float("inf"), 1.0], 0),
    (1010, [None, 1.0], 0),
    (1011, [1.0, 0.0], None),
    (None, [1.0, 0.0], 0),
    (1012, [1e30, 1e-30], 0),
    (1013, [-1.0, 0.0], 0),
]


def found(spark, rows, **options):
    table = cover_tree.similar_vectors(frame(spark, rows, SCHEMA), **options)
    out = table.collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr)


def test_odd_rows(spark):
    assert found(spark, ODD) == expected(ODD)


@pytest.mark.parametrize("block", [16, 1024])
def test_same_as_brute_force(spark, block):
    rows = clusters(3, 400) + ODD
    assert found(spark, rows, block=block, sample=64) == expected(rows)


def test_many_copies(spark):
    rows = [(i, [0.5, 0.25, -1.0], 3) for i in range(300, 100, -1)] + [(7, [0.5, 0.26, -1.0], 3)]
    assert found(spark, rows, block=8) == expected(rows)


def test_no_vectors(spark):
    assert found(spark, []) == []


def test_tree_is_nested_and_covers():
    points = cover_tree._unit(np.random.default_rng(1).standard_normal((300, 5)))
    tree = cover_tree.CoverTree(points)
    for node in range(len(tree.begin)):
        members = points[tree.order[tree.begin[node] : tree.end[node]]]
        assert np.sqrt(((members - points[tree.center[node]]) ** 2).sum(1)).max() <= tree.radius[node] + 1e-7
        if tree.children[node]:
            below = range(tree.child[node], tree.child[node] + tree.children[node])
            assert sum(tree.end[c] - tree.begin[c] for c in below) == tree.end[node] - tree.begin[node]
            assert tree.center[tree.child[node]] == tree.center[node]


@pytest.mark.parametrize("few", [0, 1 << 14])
@pytest.mark.parametrize("dims, noise", [(3, 1.0), (12, 0.12), (12, 0.3)])
def test_traversal_same_as_all_pairs_in_few_steps(monkeypatch, few, dims, noise):
    monkeypatch.setattr(cover_tree, "_FEW", few, raising=False)
    steps = []
    monkeypatch.setattr(cover_tree, "_meet", lambda *given, f=cover_tree._meet: (steps.append(1), f(*given)))
    points = [cover_tree._unit(np.array([v for _, v, _ in clusters(seed, 300, dims, 30, noise)])) for seed in (5, 5, 6)]
    pick = np.random.default_rng(7)
    weights = [pick.integers(1, 4, len(p)) for p in points]
    for i, j in ((0, 1), (0, 2)):
        steps.clear()
        links = cover_tree.dual_traversal(cover_tree.CoverTree(points[i]), cover_tree.CoverTree(points[j]), (weights[i], weights[j]), 0.93)
        near = points[i] @ points[j].T >= 0.93
        assert (links.counts[0] == near @ weights[j]).all() and (links.counts[1] == weights[i] @ near).all()
        parent = list(range(600))
        for a, b in zip(*np.nonzero(near)):
            x, y = a, b + 300
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        for k in range(600):
            root = k
            while parent[root] != root:
                root = parent[root]
            assert links.root(k) == root
        assert not few or len(steps) < 40


def test_blocks_are_sent_once_per_group(spark, monkeypatch):
    written = []
    monkeypatch.setattr(cover_tree, "materialize", lambda df, f=cover_tree.materialize: (written.append(f(df)), written[-1])[1])
    monkeypatch.setattr(cover_tree, "GROUP", 4, raising=False)
    rows = [(i, v, 0) for i, v, _ in clusters(4, 300, 8, 30, 1.0)]
    assert found(spark, rows, block=16, sample=300) == expected(rows)
    blocks = next(df for df in written if "radii" in df.columns).count()
    sent = next(df for df in written if "partners" in df.columns).count()
    groups = -(-blocks // 4)
    assert groups > 2 and sent <= groups * blocks

from __future__ import annotations

import random

import pytest

from tallymark.llm import components as C


def expected(links):
    parent = {x: x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a in parent and b in parent:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((x, root(x)) for x in parent)


@pytest.mark.parametrize("size", [7, 1 << 18])
def test_same_as_union_find(spark, monkeypatch, size):
    monkeypatch.setattr(C, "TASK_EDGES", size)
    pick = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(2000, i) for i in range(2001, 2030)]
    links = [(pick.randrange(120), pick.randrange(120)) for _ in range(60)] + chain + star + [(5, 5), (None, 3), (4, None), (7, 8), (8, 7)]
    found = C.components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    assert sorted(map(tuple, found)) == expected(links)


def test_no_links(spark):
    assert C.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0

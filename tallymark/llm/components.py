"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize

# Edges that a task turns into stars at once.
TASK_EDGES = 1 << 18


def _smallest(links: DataFrame) -> DataFrame:
    """u, m: the smallest of each node ``u`` and its neighbours ``v``. Written, so that a hub's rows can be split later."""
    return materialize(links.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_smallest(edges), "u")
    moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v")))


def _contracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars: every node but the smallest of what they connect, and that one."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            x, y = root(u), root(v)
            if x != y:
                parent[max(x, y)] = min(x, y)
    pairs = [(x, root(x)) for x in list(parent)]
    pairs = [(x, y) for x, y in pairs if x != y]
    for start in range(0, len(pairs), 1 << 16):
        part = pairs[start : start + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], pa.int64()) for i in (0, 1)], ["u", "v"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node, component: the smallest node that can be reached, for all nodes that occur in a link with another node.

    Each task first turns its share of the edges, of bounded size, into stars. Stars of several tasks are merged round by
    round: each node's larger neighbours are tied to its smallest neighbour, then its smaller ones, until nothing changes;
    rounds grow with the logarithm of a component's size. Null ends are no links.
    """
    ends = links.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b")).filter("a != b")
    edges = materialize(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    tasks = max(1, -(-edges.count() // TASK_EDGES))
    edges = materialize(edges.repartition(tasks).mapInArrow(_contracted, "u long, v long"))
    before = _state(edges)
    while tasks > 1:
        edges = materialize(_small_star(materialize(_large_star(edges).distinct())).distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)

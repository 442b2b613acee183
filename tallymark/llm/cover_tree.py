"""All pairs of similar vectors by dual traversal of cover trees.

Vectors of a label are unit vectors on a sphere, and a least cosine is a greatest chord between them, so the triangle
inequality holds. The top nodes are *blocks*: a bounded, documented sample of all vectors gives each label centers that lie
far apart, every vector goes to its nearest one, and a block's covering radius is measured over all its members (large
blocks are split by hash). Within a block a cover tree has nested levels whose radii halve. Two trees are traversed
together: a pair of nodes is dropped where the centers are further apart than both covering radii and the chord, taken as
linked whole where even the furthest members are near enough, and else opened, or compared member by member where few are
left; what remains are single pairs, whose cosine decides in double precision. A node meets all nodes of the other tree that
it is left with at once, as one product of matrices.

Equal vectors of a label are one point with a count. The blocks of a label are dealt into groups, and two groups meet in one
task, so that a block is sent once per group and not once per block that is near it. A task holds the trees of two groups and
returns a number of links and one tie per vector and pair of blocks, never the pairs.

Vectors that are null, of zero length, or hold a null or non-finite component link with nothing, nor do those with a null
label or null id, nor those of different lengths with each other. Rows with the same id are one vector to its component.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.llm.components import components

LEAST = 0.93
# Vectors from which centers are chosen, over all labels; and members that a block should have.
SAMPLE = 8_192
BLOCK = 1_024
# Blocks of a group, on average: two groups meet in a task, which holds their trees.
GROUP = 16
# Chords are known to about 1e-8: single pairs are decided by their cosine alone.
_SLACK = 1e-6
_SAME = 1e-7
_ROUNDING = 1e-12
_MATRIX = 1 << 18
# Pairs of members that take as long as one step of the traversal.
_FEW = 1 << 14
# Points whose distances to all others are taken at once when a node's children are chosen.
_SEEDS = 64


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class CoverTree:
    """Nested nodes over unit vectors. Members of node ``i`` are ``order[begin[i]:end[i]]``, its children consecutive nodes."""

    def __init__(self, points: np.ndarray):
        self.points = points
        order = np.arange(len(points))
        # Node: begin, end, center, covering radius, first child, number of children.
        nodes: list[list] = [[0, len(points), 0, 0.0, 0, 0]]
        spread = [2.0]
        at = 0
        while at < len(nodes):
            begin, end, center = nodes[at][:3]
            members = order[begin:end]
            away = _chords(points[center][None], points[members])[0]
            nodes[at][3] = float(away.max()) if len(members) > 1 else 0.0
            if len(members) > 1:
                reach = spread[at] / 2
                while reach > max(nodes[at][3], _SAME):
                    reach /= 2
                nodes[at][4] = len(nodes)
                # The node's own center is its first member, and its first child's center: levels are nested.
                # Points that can't be told apart become single children at once.
                placed = self._groups(members, reach) if nodes[at][3] > _SAME else [members[k : k + 1] for k in range(len(members))]
                for group in placed:
                    nodes.append([begin, begin + len(group), int(group[0]), 0.0, 0, 0])
                    spread.append(reach)
                    begin += len(group)
                order[end - len(members) : end] = np.concatenate(placed)
                nodes[at][5] = len(placed)
            at += 1
        self.order = order
        table = list(zip(*nodes))
        self.begin, self.end, self.center = (np.array(c, np.int64) for c in table[:3])
        self.radius = np.array(table[3])
        self.child, self.children = (np.array(c, np.int64) for c in table[4:])

    def _groups(self, left: np.ndarray, reach: float) -> list[np.ndarray]:
        """Each first point that is left, with all those left within ``reach`` of it."""
        placed = []
        while len(left):
            near = _chords(self.points[left[:_SEEDS]], self.points[left]) <= reach
            open_ = np.ones(len(left), bool)
            for k, row in enumerate(near):
                if open_[k]:
                    row &= open_
                    row[k] = True
                    placed.append(left[row])
                    open_ ^= row
            left = left[open_]
        return placed

    def members(self, node: int) -> np.ndarray:
        return self.order[self.begin[node] : self.end[node]]

    def stored(self) -> tuple[bytes, bytes]:
        """The nodes' numbers and the order of the members; the nodes' radii."""
        nodes = np.concatenate([self.begin, self.end, self.center, self.child, self.children, self.order])
        return nodes.astype("<i8").tobytes(), self.radius.tobytes()

    @classmethod
    def loaded(cls, points: np.ndarray, nodes: bytes, radius: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        tree.points, tree.radius = points, np.frombuffer(radius)
        numbers = np.frombuffer(nodes, "<i8")
        n = len(tree.radius)
        tree.begin, tree.end, tree.center, tree.child, tree.children = numbers[: 5 * n].reshape(5, n)
        tree.order = numbers[5 * n :]
        return tree


class Links:
    """What the traversal of two trees finds: weighted numbers of links, and ties that connect the same vectors."""

    def __init__(self, sizes: tuple[int, int]):
        self.counts = (np.zeros(sizes[0], np.int64), np.zeros(sizes[1], np.int64))
        self._shift = sizes[0]
        self.tied = np.arange(sum(sizes))

    def root(self, i: int) -> int:
        while self.tied[i] != i:
            self.tied[i] = self.tied[self.tied[i]]
            i = self.tied[i]
        return i

    def tie(self, rows: np.ndarray, columns: np.ndarray) -> None:
        for i, j in zip(rows.tolist(), (columns + self._shift).tolist()):
            x, y = self.root(i), self.root(j)
            if x != y:
                self.tied[max(x, y)] = min(x, y)


def dual_traversal(one: CoverTree, two: CoverTree, weights: tuple[np.ndarray, np.ndarray], least: float) -> Links:
    """Links between the points of two trees; ``weights`` are how often each point occurs.

    Of one tree with itself every pair is met from both sides, and every point with itself.
    """
    chord = float(np.sqrt(2.0 - 2.0 * least))
    found = Links((len(one.points), len(two.points)))
    stack = [(0, np.zeros(1, np.int64))]
    while stack:
        a, many = stack.pop()
        # The larger nodes are opened; nodes without children stay as they are.
        left = _opened(one, np.array([a]), one.radius[a] >= two.radius[many].max() / 2)
        right = _opened(two, many, two.radius[many] >= one.radius[a] / 2)
        step = max(1, _MATRIX // len(right))
        for begin in range(0, len(left), step):
            _meet(one, two, left[begin : begin + step], right, weights, least, chord, found, stack)
    return found


def _opened(tree: CoverTree, nodes: np.ndarray, wide: np.ndarray | bool) -> np.ndarray:
    """The children of those nodes that have some and are ``wide``, and the other nodes."""
    open_ = (tree.children[nodes] > 0) & wide
    return np.concatenate([_ranges(tree.child[nodes[open_]], tree.children[nodes[open_]]), nodes[~open_]])


def _meet(one, two, left, right, weights, least, chord, found, stack) -> None:
    cosines = one.points[one.center[left]] @ two.points[two.center[right]].T
    # Most pairs are too far apart even with the other side's greatest radius.
    most = one.radius[left] + two.radius[right].max() + (chord + _SLACK)
    rows, columns = np.nonzero(cosines >= np.minimum(1.0 - most * most / 2.0, least)[:, None] - _ROUNDING)
    if not len(rows):
        return
    cosines, a, b = cosines[rows, columns], left[rows], right[columns]
    away = np.sqrt(np.maximum(2.0 - 2.0 * cosines, 0.0))
    reach = one.radius[a] + two.radius[b]
    single = (one.children[a] == 0) & (two.children[b] == 0)
    _link(one, two, one.center[a[single]], two.center[b[single]], cosines[single], weights, least, found)
    inside = ~single & (away + reach <= chord - _SLACK)
    for i, j in zip(a[inside], b[inside]):
        p, q = one.members(i), two.members(j)
        found.counts[0][p] += weights[1][q].sum()
        found.counts[1][q] += weights[0][p].sum()
        found.tie(p, np.full(len(p), q[0]))
        found.tie(np.full(len(q), p[0]), q)
    more = ~single & ~inside & (away <= reach + chord + _SLACK)
    if more.any():
        _go_on(one, two, a[more], b[more], weights, least, found, stack)


def _go_on(one, two, a, b, weights, least, found, stack) -> None:
    """Pairs of nodes that are neither dropped nor linked: on the stack, or member by member if that is less work."""
    lefts, row = np.unique(a, return_inverse=True)
    rights, column = np.unique(b, return_inverse=True)
    heights, widths = one.end[lefts] - one.begin[lefts], two.end[rights] - two.begin[rights]
    if heights.sum() * widths.sum() > _FEW * len(lefts):
        order = np.argsort(row, kind="stable")
        for node, nodes in zip(lefts.tolist(), np.split(b[order], np.flatnonzero(np.diff(row[order])) + 1)):
            stack.append((node, nodes))
        return
    met = np.zeros((len(lefts), len(rights)), bool)
    met[row, column] = True
    q, right = _members(two, rights)
    step = max(1, _MATRIX // len(q))
    every, left = _members(one, lefts)
    for begin in range(0, len(every), step):
        p = every[begin : begin + step]
        cosines = one.points[p] @ two.points[q].T
        i, j = np.nonzero(cosines >= least - _ROUNDING)
        kept = met[left[begin + i], right[j]]
        i, j = i[kept], j[kept]
        _link(one, two, p[i], q[j], cosines[i, j], weights, least, found)


def _members(tree: CoverTree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of some nodes, and to which of the nodes each belongs."""
    sizes = tree.end[nodes] - tree.begin[nodes]
    return tree.order[_ranges(tree.begin[nodes], sizes)], np.repeat(np.arange(len(nodes)), sizes)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers from each of ``first`` on, as many as ``sizes`` says."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _link(one, two, p, q, cosines, weights, least, found) -> None:
    """Links those of the pairs of points ``p``, ``q`` whose cosine is large enough."""
    linked = cosines >= least
    # Where the rounding of the product could matter, the cosine is taken again by itself.
    for k in np.flatnonzero(np.abs(cosines - least) < _ROUNDING):
        linked[k] = float((one.points[p[k]] * two.points[q[k]]).sum()) >= least
    if linked.any():
        p, q = p[linked], q[linked]
        np.add.at(found.counts[0], p, weights[1][q])
        np.add.at(found.counts[1], q, weights[0][p])
        _tie_few(found, p, q)


def _tie_few(found: Links, p: np.ndarray, q: np.ndarray) -> None:
    """Ties that connect the same points as all pairs: each point to the first it is linked with, and firsts to each other."""
    keep = np.zeros(len(p), bool)
    keep[np.unique(p, return_index=True)[1]] = True
    keep[np.unique(q, return_index=True)[1]] = True
    found.tie(p[keep], q[keep])
    rest = np.flatnonzero(~keep)
    if len(rest):
        ends, where = np.unique(np.concatenate([p[rest], q[rest] + found._shift]), return_inverse=True)
        roots = np.array([found.root(i) for i in ends.tolist()])[where]
        open_ = rest[roots[: len(rest)] != roots[len(rest) :]]
        found.tie(p[open_], q[open_])


def _valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector (floats if given as such, else doubles) of the rows that can link."""
    vector = F.col("embedding")
    if dict(embeddings.dtypes)["embedding"] != "array<float>":
        vector = vector.cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & F.exists("vector", lambda x: x != 0.0)
    )


def _centers(points: DataFrame, sample: int, block: int) -> dict:
    """Centers by (label, length): as many as blocks are needed, each as far as can be from those before it.

    They come from at most about ``sample`` vectors, in proportion to the labels; a label that isn't in the sample has none.
    """
    total = points.count()
    if not total:
        return {}
    share = min(1.0, sample / total)
    chosen = points.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    out: dict = {}
    groups: dict = {}
    for row in chosen.select("label", "vec_id", "vector").limit(2 * sample).collect():
        groups.setdefault((row.label, len(row.vector)), []).append((row.vec_id, row.vector))
    for key, rows in groups.items():
        rows = _unit(np.array([vector for _, vector in sorted(rows)]))
        wanted = min(len(rows), int(np.ceil(len(rows) / share / block)))
        centers, nearest = [0], _chords(rows[:1], rows)[0]
        while len(centers) < wanted:
            centers.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _chords(rows[centers[-1:]], rows)[0])
        out[key] = rows[centers]
    return out


def _assigned(points: DataFrame, centers: dict) -> DataFrame:
    """``points`` with ``center``: the number of the nearest center of their label."""

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            lengths = batch.column("vector").value_lengths().to_numpy()
            numbers = batch.column("vector").flatten().to_numpy()
            begin = np.cumsum(lengths) - lengths
            groups: dict = {}
            for i, key in enumerate(zip(batch.column("label").to_pylist(), lengths.tolist())):
                groups.setdefault(key, []).append(i)
            for key, rows in groups.items():
                if key in centers:
                    vectors = numbers[begin[rows][:, None] + np.arange(key[1])].astype(np.float64)
                    found[rows] = (_unit(vectors) @ centers[key].T).argmax(1)
            yield batch.append_column("center", pa.array(found))

    kinds = dict(points.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("vec_id", "label", "n", "vector")) + ", center long"
    return points.select("vec_id", "label", "n", "vector").mapInArrow(assign, schema)


def _tree_row(table: pa.Table) -> pa.Table:
    """The block of a group of points: its head, and the cover tree of its points in order of id."""
    table = table.sort_by("vec_id")
    vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    points = _unit(vectors.astype(np.float64))
    center = points.mean(0)
    size = float(np.sqrt((center * center).sum()))
    center = center / size if size > 1e-9 else points[0]
    away = np.sqrt(((points - center) ** 2).sum(1))
    nodes, radii = CoverTree(points).stored()
    return pa.table(
        {
            "label": [str(table.column("label")[0].as_py())],
            "dims": pa.array([points.shape[1]], pa.int32()),
            "block": table.column("block")[:1],
            "middle": pa.array([center.tolist()], pa.list_(pa.float64())),
            "radius": pa.array([float(away.max())], pa.float64()),
            "ids": pa.array([table.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "times": pa.array([table.column("n").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "points": pa.array([vectors.tobytes()], pa.binary()),
            "nodes": pa.array([nodes], pa.binary()),
            "radii": pa.array([radii], pa.binary()),
        }
    )


_TREE = ("ids", "times", "points", "nodes", "radii")
_BLOCKS = "label string, dims int, block long, middle array<double>, radius double, " + ", ".join(f"{c} binary" for c in _TREE)


def _loaded(row: dict) -> tuple[CoverTree, np.ndarray, np.ndarray]:
    """Tree, ids and counts of a block; its vectors are kept as they were given, in four or eight bytes a number."""
    ids, times = (np.frombuffer(row[c], "<i8") for c in ("ids", "times"))
    size = len(row["points"]) // (len(ids) * row["dims"])
    vectors = np.frombuffer(row["points"], f"<f{size}").reshape(len(ids), -1)
    return CoverTree.loaded(_unit(vectors.astype(np.float64)), row["nodes"], row["radii"]), ids, times


def _compare(table: pa.Table, least: float) -> pa.Table:
    """Links of blocks with their partners: per vector its number of links, and a vector that it is connected with."""
    rows = table.to_pylist()
    blocks = {row["block"]: _loaded(row) for row in rows}
    out = [[np.zeros(0, np.int64)] * 3]
    for row in rows:
        for partner in row["partners"]:
            (one, ids1, times1), (two, ids2, times2) = blocks[row["block"]], blocks[partner]
            found = dual_traversal(one, two, (times1, times2), least)
            if not found.counts[0].any():
                continue
            every, counts = np.concatenate([ids1, ids2]), np.concatenate(found.counts)
            if row["block"] == partner:
                # Both sides are the same points, and a point's links don't include itself.
                found.tie(np.arange(len(ids1)), np.arange(len(ids1)))
                every, counts = ids1, found.counts[0] - 1
            others = every[[found.root(k) for k in range(len(every))]]
            kept = (counts != 0) | (every != others)
            out.append([every[kept], counts[kept], others[kept]])
    return pa.table({name: np.concatenate(x) for name, x in zip(("vec_id", "links", "other"), zip(*out))})


def similar_vectors(embeddings: DataFrame, least: float = LEAST, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id (smallest linked id) and kept."""
    rows = materialize(_valid(embeddings))
    points = materialize(
        rows.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"))
    )
    assigned = materialize(_assigned(points, _centers(points, sample, block)))
    dims = F.size("vector").alias("dims")
    sizes = materialize(assigned.groupBy("label", dims, "center").agg(F.ceil(F.count(F.lit(1)) / (2 * block)).alias("splits")))
    placed = assigned.withColumn("dims", F.size("vector")).join(sizes, ["label", "dims", "center"])
    placed = placed.withColumn("split", F.pmod(F.xxhash64("vec_id"), F.col("splits")))
    block_of = F.xxhash64(F.col("label").cast("string"), "dims", "center", "split")
    placed = placed.select(block_of.alias("block"), "label", "vec_id", "n", "vector")
    blocks = materialize(placed.groupBy("block").applyInArrow(_tree_row, _BLOCKS))

    heads = blocks.select("label", "dims", "block", "middle", "radius")
    groups = heads.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
    heads = heads.join(groups, ["label", "dims"]).withColumn("group", F.pmod(F.xxhash64("block"), F.col("groups")))
    one, two = heads.alias("one"), heads.alias("two")
    apart = F.aggregate(F.zip_with("one.middle", "two.middle", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    chord = float(np.sqrt(2.0 - 2.0 * least))
    near = F.sqrt(apart) <= F.col("one.radius") + F.col("two.radius") + chord + _SLACK
    kind = (F.col("one.label") == F.col("two.label")) & (F.col("one.dims") == F.col("two.dims"))
    pairs = one.join(two, kind & (F.col("one.block") <= F.col("two.block")) & near)
    meeting = F.xxhash64("one.label", "one.dims", F.least("one.group", "two.group"), F.greatest("one.group", "two.group"))
    pairs = materialize(pairs.select(meeting.alias("meeting"), F.col("one.block").alias("one"), F.col("two.block").alias("two")))
    # Each block once per meeting, with those that it is compared with there.
    as_one = pairs.select("meeting", F.col("one").alias("block"), F.col("two").alias("partner"))
    as_two = pairs.select("meeting", F.col("two").alias("block"), F.lit(None).cast("long").alias("partner"))
    sides = materialize(as_one.union(as_two).groupBy("meeting", "block").agg(F.collect_list("partner").alias("partners")))
    sent = sides.join(blocks.select("block", "dims", *_TREE), "block")
    # More parts than cores: meetings differ in size.
    partitions = 4 * int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = sent.repartition(partitions, "meeting").groupBy("meeting")
    found = materialize(met.applyInArrow(lambda table: _compare(table, least), "vec_id long, links long, other long"))

    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    parts = components(found, "vec_id", "other").withColumnRenamed("node", "vec_id")
    known = points.select("label", "vector", "vec_id", "n").join(counts, "vec_id", "left").join(parts, "vec_id", "left")
    known = materialize(
        known.select(
            "label",
            "vector",
            F.coalesce("links", F.col("n") - 1).alias("links"),
            F.coalesce("component", "vec_id").alias("component"),
        )
    )
    linked = rows.join(known, ["label", "vector"]).groupBy("vec_id").agg(
        F.max("links").alias("links"), F.min("component").alias("component")
    )
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).join(linked, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return every.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )

"""Near copies of texts by DartMinHash over weighted word shingles.

**Signatures.** A text is the set of its five-word shingles; one that occurs ``c`` times weighs ``1 + ln c``. Every shingle
has darts at fixed random places of a plane, weight by rank: a Poisson process of one dart per unit of area, taken strip
by strip of the weight ([0,1), [1,2), [2,4), ...), in each strip in order of rank and from hashes alone, so that the same
shingle has the same darts in every text. A text keeps the darts below its shingles' weights and below a rank that gives
``k ln k + 2k`` of them on average whatever its length; each falls on one of ``k`` coordinates, and the earliest of each
coordinate is kept. (Where a coordinate has none, the rank is doubled for that text.) Two texts agree in a coordinate with
a chance of their weighted Jaccard similarity.

**Links.** Texts that agree in a whole band of coordinates are candidates, and each candidate pair is compared exactly.
Texts with the same weighted shingles are one node from the start. In each bucket every node is first compared with the
smallest one, which leaves a thousand copies in one component at the cost of one comparison each. Candidates of different
components are then compared in blocks of bounded size; pairs of blocks within one component are never made. So no link
between different components is lost.

Texts of one to four words have one shingle of all of them. Texts without words, null among them, are near copies of
nothing. Rows with the same doc_id are one document; rows with a null doc_id are copies of nothing and have a null class.
Other columns are kept by ``deduplicated`` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 agrees in one of 16 bands of 4 coordinates with a chance of 0.9998.
BANDS, ROWS = 16, 4
# Nodes, and shingles, that are compared with as many others at once.
BLOCK, BLOCK_SHINGLES = 2_048, 1 << 20
_TEXTS = 128
# Of the filter that tells which texts to cut into shingles a second time: 1 MB whatever the corpus.
FILTER_BITS = 1 << 23

_WORD = re.compile(r"[^\W_]+")
_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + _MIX[2]
    x = (x ^ (x >> _U(30))) * _MIX[0]
    x = (x ^ (x >> _U(27))) * _MIX[1]
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes, and their weights."""

    def __init__(self, size: int = SHINGLE):
        self._size = size
        self._known: dict[str, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        import xxhash

        words = _WORD.findall((text or "").lower())
        if not words:
            return np.zeros(0, _U)
        known = self._known
        if len(known) > 300_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        each = np.fromiter(map(known.__getitem__, words), _U, len(words))
        size = min(self._size, len(words))
        rolled = np.full(len(words) - size + 1, _U(size))
        for i in range(size):
            rolled = _mixed(rolled ^ each[i : len(words) - size + 1 + i])
        return rolled

    def weighted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found, counts = np.unique(self.hashes(text), return_counts=True)
        return found, 1.0 + np.log(counts)


def darts(elements: np.ndarray, weights: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(which, rank, dart)`` of all darts below each element's weight and rank limit."""
    which, ranks, ids = [], [], []
    low, high, strip = 0.0, 1.0, 0
    inside = np.arange(len(elements))
    while len(inside):
        width = high - low
        at = inside
        rank = np.zeros(len(at))
        seed = _mixed(elements[at] ^ _mixed(np.array([strip + 1], _U)))
        nth = 0
        while len(at):
            dart = _mixed(seed + _U(nth * int(_MIX[2]) & (1 << 64) - 1))
            rank = rank - np.log(_unit(dart)) / width
            near = rank <= limits[at]
            at, rank, seed, dart = at[near], rank[near], seed[near], dart[near]
            height = low + width * _unit(_mixed(dart ^ _MIX[0]))
            hit = height <= weights[at]
            which.append(at[hit])
            ranks.append(rank[hit])
            ids.append(_mixed(dart ^ _MIX[1]))
            ids[-1] = ids[-1][hit]
            nth += 1
        low, high, strip = high, 2 * high, strip + 1
        inside = inside[weights[inside] > low]
    return np.concatenate(which), np.concatenate(ranks), np.concatenate(ids)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """One row of ``k`` darts per weighted set; sets must not be empty."""
    out = np.zeros((len(sets), k), _U)
    missing = np.arange(len(sets))
    wanted = k * np.log(k) + 2 * k
    while len(missing):
        parts = [sets[i] for i in missing]
        owner = np.repeat(np.arange(len(parts)), [len(e) for e, _ in parts])
        elements = np.concatenate([e for e, _ in parts])
        weights = np.concatenate([w for _, w in parts])
        limit = wanted / np.array([w.sum() for _, w in parts])
        which, rank, dart = darts(elements, weights, limit[owner])
        place = owner[which] * k + (dart % _U(k)).astype(np.int64)
        order = np.lexsort((dart, rank, place))
        place, dart = place[order], dart[order]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        rows = np.zeros((len(parts), k), _U)
        filled = np.zeros((len(parts), k), bool)
        rows.reshape(-1)[place[first]] = dart[first]
        filled.reshape(-1)[place[first]] = True
        out[missing] = rows
        missing = missing[~filled.all(1)]
        wanted *= 2
    return out


def banded(rows: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band of coordinates."""
    parts = rows.reshape(len(rows), bands, -1)
    found = np.broadcast_to(np.arange(bands, dtype=_U), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        found = _mixed(found ^ parts[:, :, i])
    return found


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of smaller weights over the sum of larger ones."""
    total = a[1].sum() + b[1].sum()
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0]
    shared = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(shared / (total - shared)) if total else 0.0


def _stored(found: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Shingles as bytes, and the weights where any differs from 1."""
    weights = b"" if (found[1] == 1).all() else found[1].tobytes()
    return len(found[0]).to_bytes(8, "little") + found[0].tobytes() + weights


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _loaded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    weights = np.frombuffer(data, np.float64, n, 8 + 8 * n) if len(data) > 8 + 8 * n else np.ones(n)
    return np.frombuffer(data, _U, n, 8), weights


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, content, bands, size: of texts with words a digest and the number of weighted shingles, and band hashes."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                sets = [shingler.weighted(text) for text in part.column("text").to_pylist()]
                kept = [i for i, found in enumerate(sets) if len(found[0])]
                if not kept:
                    continue
                sets = [sets[i] for i in kept]
                hashes = banded(signatures(sets, bands * rows), bands).view(np.int64)
                content = [_digest(_stored(found)) for found in sets]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(hashes.reshape(-1)), bands).cast(pa.list_(pa.int64()))
                sizes = pa.array([len(found[0]) for found in sets], pa.int64())
                columns = [part.column("doc_id").take(pa.array(kept)), pa.array(content, pa.binary()), lists, sizes]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "bands", "size"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    return texts.mapInArrow(sign, "doc_id long, content binary, bands array<long>, size long")


def _places(node: str) -> list[Column]:
    """Where a node's bits are in the filter of nodes."""
    return [F.pmod(F.xxhash64(node, F.lit(i)), F.lit(FILTER_BITS)) for i in range(2)]


def _filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of ``nodes``: a number of bits that doesn't grow with them, put together from counted words."""
    bits = nodes.select(F.explode(F.array(*_places("node"))).alias("bit"))
    word = F.shiftrightunsigned("bit", 6).alias("word")
    one = F.expr("shiftleft(1L, int(bit & 63L))")
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    for row in bits.groupBy(word).agg(F.bit_or(one).alias("value")).collect():
        out[row.word] = row.value
    return out.view(_U)


def shingled(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles: the stored weighted shingles of the documents in ``nodes``, one row per id and distinct shingles.

    Texts stay where they are read: a Bloom filter of the nodes tells which ones to cut. It lets through a few documents
    that are none of them; the joins that follow don't.
    """
    bits = _filter(nodes)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            places = [batch.column(name).to_numpy().astype(np.int64) for name in ("one", "two")]
            met = [(bits[p >> 6] >> (p & 63).astype(_U)) & _U(1) for p in places]
            batch = batch.filter(pa.array((met[0] & met[1]).astype(bool)))
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                data = [_stored(shingler.weighted(text)) for text in part.column("text").to_pylist()]
                columns = [pa.array(map(_digest, data), pa.binary()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("node"), *columns], ["node", "content", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").filter(F.col("node").isNotNull())
    one, two = _places("node")
    found = texts.withColumns({"one": one, "two": two}).mapInArrow(cut, "node long, content binary, shingles binary")
    return found.dropDuplicates(["node", "content"]).select("node", "shingles")


def _similar(pairs: DataFrame, least: float) -> DataFrame:
    """The rows of ``a, b, left, right`` whose stored shingles are similar enough."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: tuple[int | None, tuple] = (None, ())
            keep = []
            for b, left, right in zip(batch.column("b").to_pylist(), batch.column("left"), batch.column("right")):
                if held[0] != b:
                    held = (b, _loaded(right.as_py()))
                keep.append(similarity(_loaded(left.as_py()), held[1]) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def _blocks(pairs: DataFrame, found: DataFrame, signs: DataFrame) -> DataFrame:
    """family, node, component, bands, block: the nodes of families of several components.

    A family is what candidate pairs connect. Its nodes are in order of component and cut into blocks of bounded size; as
    they are ranges of one sort, no task holds a family.
    """
    family = materialize(components(pairs, "a", "b")).withColumnRenamed("component", "family")
    mixed = materialize(family.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    several = mixed.groupBy("family").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    left = mixed.join(materialize(several.select("family")), "family", "left_semi").join(signs, "node")
    order = ["family", "component", "node"]
    ranged = left.select("family", "component", "node", "bands", "size").repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, nodes, shingles, last = TaskContext.get().partitionId() << 40, 0, 0, None
        for batch in batches:
            out = []
            for family, size in zip(batch.column("family").to_pylist(), batch.column("size").to_pylist()):
                if family != last or nodes == BLOCK or shingles + size > BLOCK_SHINGLES:
                    block, nodes, shingles, last = block + 1, 0, 0, family
                nodes, shingles = nodes + 1, shingles + size
                out.append(block)
            yield batch.append_column("block", pa.array(out, pa.int64()))

    schema = "family long, component long, node long, bands array<long>, size long, block long"
    return materialize(ranged.mapInArrow(number, schema))


def _rest(docs: DataFrame, pairs: DataFrame, found: DataFrame, signs: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` between different components that agree in a band, compared block by block."""
    blocks = _blocks(pairs, found, signs)
    heads = materialize(
        blocks.groupBy("family", "block").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    )
    one, two = heads.alias("one"), heads.alias("two")
    several = (F.col("one.x") != F.col("one.y")) | (F.col("two.x") != F.col("two.y")) | (F.col("one.x") != F.col("two.x"))
    met = one.join(two, (F.col("one.family") == F.col("two.family")) & (F.col("one.block") <= F.col("two.block")) & several)
    met = met.select(F.col("one.block").alias("left"), F.col("two.block").alias("right"))
    met = materialize(met.withColumn("pair", F.monotonically_increasing_id()))
    # A block that is compared with itself is sent once.
    sides = met.select("pair", F.col("left").alias("block"), F.lit(0).alias("side")).union(
        met.filter("left < right").select("pair", F.col("right").alias("block"), F.lit(1).alias("side"))
    )
    shingles = materialize(shingled(docs, blocks.select("node")))
    # Both sides of these joins grow with the data: none is sent whole, however small it is today.
    data = materialize(blocks.select("block", "node", "component", "bands").hint("merge").join(shingles, "node"))
    rows = sides.hint("merge").join(data, "block")

    def compare(table: pa.Table) -> pa.Table:
        sides = [table.filter(pc.equal(table.column("side"), s)) for s in (0, 1)]
        sides = sides if len(sides[1]) else [sides[0], sides[0]]
        nodes = [t.column("node").to_pylist() for t in sides]
        parts = [t.column("component").to_numpy() for t in sides]
        bands = [np.array(t.column("bands").to_pylist(), np.int64) for t in sides]
        stored = [t.column("shingles") for t in sides]
        tied: dict[int, int] = {}

        def root(x: int) -> int:
            while tied.get(x, x) != x:
                tied[x] = tied.get(tied[x], tied[x])
                x = tied[x]
            return x

        out = []
        for i in range(len(nodes[0])):
            agree = (bands[1] == bands[0][i]).any(1) & (parts[1] != parts[0][i])
            mine = None
            for j in np.flatnonzero(agree).tolist():
                x, y = root(int(parts[0][i])), root(int(parts[1][j]))
                if x == y:
                    continue
                mine = mine or _loaded(stored[0][i].as_py())
                if similarity(mine, _loaded(stored[1][j].as_py())) >= least:
                    tied[max(x, y)] = min(x, y)
                    out.append((nodes[0][i], nodes[1][j]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return rows.groupBy("pair").applyInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id: for each distinct doc_id of a text with words, the smallest doc_id of its class."""
    signs = materialize(signed(docs, bands, rows))
    same = materialize(signs.groupBy("content").agg(F.min("doc_id").alias("node")))
    node_of = materialize(signs.select("doc_id", "content").join(same, "content").select("doc_id", "node"))
    firsts = signs.join(same, "content").filter("doc_id = node").dropDuplicates(["node", "content"])
    firsts = materialize(firsts.select("node", "bands", "size"))
    each = firsts.select("node", F.posexplode("bands").alias("band", "bucket"))
    buckets = each.groupBy("band", "bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    members = each.join(materialize(buckets.drop("last")), ["band", "bucket"])
    pairs = members.filter("node != first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    pairs = materialize(pairs)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    shingles = materialize(shingled(docs, ends))
    # Both sides of these joins grow with the data: none is sent whole, however small it is today.
    both = pairs.hint("merge").join(shingles.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.hint("merge").join(shingles.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    links = materialize(_similar(both, least))
    found = materialize(components(links, "a", "b"))
    # Rows of one doc_id with different texts tie their nodes.
    owners = node_of.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b < top")
    tied = node_of.join(owners, "doc_id").filter("node != b").select(F.col("node").alias("a"), "b")
    more = materialize(_rest(docs, pairs, found, firsts, least).union(tied))
    if not more.isEmpty():
        found = materialize(components(links.union(more), "a", "b"))
    every = node_of.groupBy("doc_id").agg(F.min("node").alias("node"))
    joined = materialize(every).join(found, "node", "left")
    return joined.select("doc_id", F.coalesce("component", "node").alias("class_id"))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id of its class) and kept (whether it is that one)."""
    found = materialize(near_copies(docs, least))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return ids.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without those of documents that are near copies of one with a smaller doc_id."""
    found = near_copies(docs, least).filter("doc_id != class_id").select(F.col("doc_id").alias("__copy"))
    return docs.join(found, docs["doc_id"].cast("long") == F.col("__copy"), "left_anti")

r"""Centroid clustering by Lloyd's method, with the dimensions dealt over shards.

Vectors become integers, so that all sums are exact and a result doesn't depend on the order of anything. They are cut twice:
into chunks of rows, and each chunk into shards of columns. A task that holds a chunk's shard needs the same columns of the
centroids only, and computes exact partial squared distances of its rows to all centroids. A reduction by chunk adds the
shards' partial distances and takes the least. The chosen clusters go back to the shards, each of which adds up its own
columns per cluster and makes the new slice of the centroids.

The shards are written once, bucketed by chunk and shard, so that no later round moves a vector: what is shuffled are
partial distances (one number per row, centroid and shard) and the clusters of the rows. The driver holds the centroids,
whose number and length are parameters.

Kept are vectors of the given length without null or non-finite components, and with none beyond ``LARGEST``, since the
distance of such a vector would not fit a long. Null ids are taken as empty in the choice of the first centroids; vectors with
the same id are chosen in order of their components and clustered each for itself, equal ones too. With fewer vectors than
centroids there are as many centroids as vectors; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize, shared_folder
from tallymark.operators.skew import shuffle_partitions

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1
# Rows of a chunk and columns of a shard.
CHUNK = 4_096
SHARD = 32
LARGEST = float(1 << 21)

_SLICES = "chunk long, shard int, kind string, data binary, ids array<long>"


def _smallest_kind(values: np.ndarray) -> np.ndarray:
    """The values in the shortest little-endian integers that hold them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in ("<i1", "<i2", "<i4"):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype("<i8")


def _sliced(batches: Iterable[pa.RecordBatch], dims: int, chunk: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Chunks of rows, each cut into shards of columns; the first shard has the ids."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        ids = batch.column("vec_id")
        for begin in range(0, len(vectors), chunk):
            rows = vectors[begin : begin + chunk]
            found: dict[str, list] = {"chunk": [], "shard": [], "kind": [], "data": [], "ids": []}
            for nth, start in enumerate(range(0, dims, shard)):
                part = _smallest_kind(rows[:, start : start + shard])
                values = (number, nth, part.dtype.str, part.tobytes(), ids[begin : begin + chunk].to_pylist() if nth == 0 else None)
                for name, value in zip(found, values):
                    found[name].append(value)
            types = (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), types)], list(found))
            number += 1


def _rows(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width).astype(np.int64)


def _partial_distances(batches: Iterable[pa.RecordBatch], centroids: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
    """Per chunk and shard the squared distances in the shard's columns, rows by centroids."""
    for batch in batches:
        for i in range(batch.num_rows):
            nth = batch.column("shard")[i].as_py()
            slice_ = centroids[:, nth * shard : (nth + 1) * shard]
            x = _rows(batch.column("kind")[i].as_py(), batch.column("data")[i].as_py(), slice_.shape[1])
            away = (x * x).sum(1)[:, None] - 2 * (x @ slice_.T) + (slice_ * slice_).sum(1)
            packed = _smallest_kind(away)
            columns = [[batch.column("chunk")[i].as_py()], [packed.dtype.str], [packed.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "kind", "data"])


def _nearest(parts: pa.Table, k: int) -> pa.Table:
    """The shards' partial distances of a chunk added up: each row's cluster, the smaller one of equals, and its distance."""
    total = None
    for kind, data in zip(parts.column("kind").to_pylist(), parts.column("data").to_pylist()):
        part = _rows(kind, data, k)
        total = part if total is None else total + part
    cluster = total.argmin(1)
    least = total[np.arange(len(total)), cluster]
    arrays = {"chunk": parts.column("chunk")[:1], "cluster": [cluster.astype("<i4").tobytes()], "distance": [least.astype("<i8").tobytes()]}
    return pa.table(arrays)


def _slice_sums(batches: Iterable[pa.RecordBatch], k: int, dims: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Per shard, cluster and column the sum over the task's rows, and their number."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            nth = batch.column("shard")[i].as_py()
            width = min(shard, dims - nth * shard)
            x = _rows(batch.column("kind")[i].as_py(), batch.column("data")[i].as_py(), width)
            cluster = np.frombuffer(batch.column("cluster")[i].as_py(), "<i4")
            if nth not in sums:
                sums[nth], counts[nth] = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
            np.add.at(sums[nth], cluster, x)
            counts[nth] += np.bincount(cluster, minlength=k)
    for nth, total in sums.items():
        cluster, column = np.indices(total.shape).reshape(2, -1)
        arrays = (np.full(total.size, nth * shard) + column, cluster, total.reshape(-1), counts[nth][cluster])
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], ["dim", "cluster", "total", "n"])


def _by_vector(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            cluster = np.frombuffer(batch.column("cluster")[i].as_py(), "<i4")
            distance = np.frombuffer(batch.column("distance")[i].as_py(), "<i8")
            ids = batch.column("ids")[i].values
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])


class _Sharded:
    """Vectors as a table of shards, bucketed by chunk and shard."""

    def __init__(self, points: DataFrame, dims: int):
        self._spark, self._dims, self._path = points.sparkSession, dims, shared_folder(points.sparkSession)
        self._name = f"tallymark_slices_{uuid.uuid4().hex}"
        buckets = shuffle_partitions(points)
        made = points.mapInArrow(partial(_sliced, dims=dims, chunk=CHUNK, shard=SHARD), _SLICES)
        made = made.repartition(buckets, "chunk", "shard")
        made.write.bucketBy(buckets, "chunk", "shard").option("path", self._path).saveAsTable(self._name)

    def forget(self) -> None:
        """Only the name: the files stay for what is still to be read."""
        self._spark.sql(f"DROP TABLE IF EXISTS {self._name}")

    def nearest(self, centroids: np.ndarray) -> DataFrame:
        parts = self._spark.table(self._name).select("chunk", "shard", "kind", "data")
        parts = parts.mapInArrow(
            partial(_partial_distances, centroids=centroids, shard=SHARD), "chunk long, kind string, data binary"
        )
        k = len(centroids)

        def nearest(shards: pa.Table) -> pa.Table:
            return _nearest(shards, k)

        return materialize(parts.groupBy("chunk").applyInArrow(nearest, "chunk long, cluster binary, distance binary"))

    def moved(self, centroids: np.ndarray, nearest: DataFrame) -> np.ndarray:
        """New centroids: of each shard's columns the floor of the clusters' means; empty clusters stay."""
        shards = -(-self._dims // SHARD)
        sent = nearest.select("chunk", "cluster", F.explode(F.lit(list(range(shards)))).alias("shard"))
        slices = self._spark.table(self._name).select("chunk", "shard", "kind", "data")
        sums = slices.join(sent, ["chunk", "shard"]).mapInArrow(
            partial(_slice_sums, k=len(centroids), dims=self._dims, shard=SHARD), "dim long, cluster long, total long, n long"
        )
        means = sums.groupBy("dim", "cluster").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0")
        out = centroids.copy()
        for row in means.select("dim", "cluster", F.expr("(total - pmod(total, n)) div n").alias("mean")).collect():
            out[row.cluster, row.dim] = row.mean
        return out

    def by_vector(self, nearest: DataFrame) -> DataFrame:
        ids = self._spark.read.schema(_SLICES).parquet(self._path).filter("shard = 0").select("chunk", "ids")
        return ids.join(nearest, "chunk").select("ids", "cluster", "distance").mapInArrow(
            _by_vector, "vec_id long, cluster int, distance long"
        )


def _points(embeddings: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and vector (whole numbers) of the vectors that are kept."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: F.coalesce(F.abs(x) <= LARGEST, F.lit(False)))
    whole = F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return rows.filter((F.size("x") == dims) & fine).select("vec_id", whole.alias("vector"))


def clusters(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and (squared) distance of every kept vector after ``rounds`` rounds, and the centroids.

    The first centroids are the vectors with the smallest hashes of seed and id.
    """
    points = _points(embeddings, dims, scale)
    chance = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = points.select(chance.alias("chance"), "vector").orderBy("chance", "vector").limit(k).collect()
    if not first:
        return points.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = np.array([row.vector for row in first], np.int64)
    sharded = _Sharded(points, dims)
    try:
        for _ in range(rounds):
            centroids = sharded.moved(centroids, sharded.nearest(centroids))
        found = materialize(sharded.by_vector(sharded.nearest(centroids)))
    finally:
        sharded.forget()
    return found, centroids.tolist()


def clustered(embeddings: DataFrame, **options: int) -> DataFrame:
    """:func:`clusters` with cluster_inertia and inertia (sums of distances) and the hash of the row's centroid.

    Sums beyond a long are null.
    """
    found, centroids = clusters(embeddings, **options)
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    total = sum(sums.values())
    longest = (1 << 63) - 1
    rows = [
        (i, *[int(s) if s <= longest else None for s in (sums.get(i, 0), total)], hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids)
    ]
    known = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

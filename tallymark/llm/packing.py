"""Best-fit packing of token pieces into sequences, planned over the histogram of lengths.

1. Texts are encoded; documents longer than a sequence are cut into pieces. Each task numbers its pieces within each
   length, and the pieces are written.
2. The histogram of lengths (at most one entry per possible length, however large the corpus) is packed by best fit,
   longest first: sequences in the same state are one *run*, so that a step places thousands of equal pieces at once. The
   plan says for a length: "pieces ``first`` to ``first + n`` go to the sequences from ``sequence`` on, ``each`` per
   sequence, from ``offset`` on". Its size depends on the capacity, not on the number of documents.
3. A piece's rank within its length is its task's first rank plus its number in the task; joining on length and rank
   gives its place.

A null text counts as empty and, like an empty one, is the end id alone. Rows may repeat or have a null id; each is packed
by itself. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_broadcast, materialize
from tallymark.llm.tokens import encoded, vocabulary

CAPACITY = 4096

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
_PLAN = "length long, first long, n long, sequence long, offset long, each long"


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first, n, sequence, offset, each)`` rows that place ``lengths[length]`` pieces of every length.

    Best fit, longest first: a piece goes to the fullest sequence that still has room.
    """
    rows = []
    runs: list[tuple[int, int, int]] = []  # (room, first sequence, number of sequences), by room
    opened = 0
    for length in sorted(lengths, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens can't be packed into {capacity}")
        left, first = lengths[length], 0
        while left > 0:
            at = bisect.bisect_left(runs, (length, -1, -1))
            if at < len(runs):
                room, sequence, n = runs.pop(at)
            else:
                room, sequence, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = room // length
            placed = min(left, n * each)
            rows.append((length, first, placed, sequence, capacity - room, each))
            full, more = divmod(placed, each)
            for size, count, start in (
                (room - each * length, full, sequence),
                (room - more * length, int(more > 0), sequence + full),
                (room, n - full - (more > 0), sequence + full + (more > 0)),
            ):
                if count and size:
                    bisect.insort(runs, (size, start, count))
            left, first = left - placed, first + placed
    return rows


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of all texts, with the number of each within its length and task (``part``)."""
    path = path or vocabulary()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch, ids in encoded(batches, path):
            doc_ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, data in zip(doc_ids, ids):
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    held = data[at : at + 4 * capacity]
                    length = len(held) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(held), part, int(seen[length])))
                    seen[length] += 1
            names = [field.split()[0] for field in _PIECES.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            if rows:
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of written pieces."""
    spark = cut.sparkSession
    counts = materialize(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = dict(map(tuple, counts.groupBy("length").agg(F.sum("n")).collect()))
    slots = bounded_broadcast(spark.createDataFrame(plan(histogram, capacity), _PLAN))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bounded_broadcast(materialize(bases)), ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth"))
    here = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    met = ranked.join(slots.withColumnRenamed("length", "slot"), (F.col("length") == F.col("slot")) & here)
    inside = F.col("rank") - F.col("first")
    return met.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(inside / F.col("each")).cast("long")).alias("sequence_id"),
        (F.col("offset") + F.pmod(inside, F.col("each")) * F.col("length")).alias("offset"),
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(materialize(pieces(docs, capacity, path)), capacity)

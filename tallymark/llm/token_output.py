"""Token ids in files: frequency-ranked, byte-aligned variable-length codes with their control bytes apart.

The most frequent id has rank 0 and so on; ties go to the smaller id. A rank takes one to four bytes; two bits tell how
many, four ranks share a control byte, and all control bytes of a file come before its data bytes. The decoder looks up the
four sizes of each control byte and so finds the bytes of all numbers of a file at once.

A file (little-endian): the magic ``TMRK``; uint32 version, number of documents, number of ids; uint64 ids before it in
its part, number of data bytes; then per document int64 id, uint8 null flag and uint32 length; control bytes; data bytes.
``ranks`` beside the files is the list of ids by rank. Parts are ranges of doc_id, and files of a part follow each other:
``part-00003-00001.tmrk``.

A null text is empty and an empty one is the end id alone. Rows with equal ids are in the order of their token bytes, null
ids come first. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_broadcast, materialize, shared_folder
from tallymark.llm.files import Writing, reading
from tallymark.llm.tokens import Encoder, encoded, vocabulary

MAGIC, VERSION = b"TMRK", 1
_HEAD = "<4sIIIQQ"
# A file is closed after the document with which it has so many ids.
FILE_IDS = 4 << 20
#: For each control byte the sizes of its four numbers.
_SIZES = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.uint8)


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = np.asarray(numbers, "<u4")
    sizes = np.ones(len(numbers), np.uint8)
    for most in (0xFF, 0xFFFF, 0xFFFFFF):
        sizes += numbers > most
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    codes[: len(numbers)] = sizes - 1
    quarters = codes.reshape(-1, 4)
    control = quarters[:, 0] | quarters[:, 1] << 2 | quarters[:, 2] << 4 | quarters[:, 3] << 6
    ends = np.cumsum(sizes, dtype=np.int64)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    places, left = ends - sizes, numbers
    data[places] = left.astype(np.uint8)
    for byte in range(1, 4):
        # Ever fewer numbers have another byte.
        longer = np.flatnonzero(sizes > byte)
        sizes, places, left = sizes[longer], places[longer], left[longer]
        data[places + byte] = (left >> np.uint32(8 * byte)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers: a table lookup per control byte gives four sizes, their sums the places of the bytes."""
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    places = np.cumsum(sizes, dtype=np.int64) - sizes
    source = np.frombuffer(data, np.uint8)
    out = source[places].astype("<u4")
    which = np.arange(count)
    for byte in range(1, 4):
        longer = np.flatnonzero(sizes > byte)
        sizes, places, which = sizes[longer], places[longer], which[longer]
        out[which] |= source[places + byte].astype("<u4") << np.uint32(8 * byte)
    return out


def encode_file(doc_ids: list[int | None], lengths: list[int], ranks: np.ndarray, before: int) -> bytes:
    control, data = encode_numbers(ranks)
    head = struct.pack(_HEAD, MAGIC, VERSION, len(doc_ids), len(ranks), before, len(data))
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes()
    nulls = np.array([i is None for i in doc_ids], np.uint8).tobytes()
    return b"".join((head, ids, nulls, np.array(lengths, "<u4").tobytes(), control, data))


def decode_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """doc_ids, lengths, ranks, and the number of ids before the file in its part."""
    magic, version, n, count, before, size = struct.unpack_from(_HEAD, content)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a file of ranked token ids")
    at = struct.calcsize(_HEAD)
    doc_ids = np.frombuffer(content, "<i8", n, at).tolist()
    nulls = np.frombuffer(content, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(content, "<u4", n, at + 9 * n)
    at += 13 * n
    control = content[at : at + -(-count // 4)]
    ranks = decode_numbers(control, content[at + len(control) : at + len(control) + size], count)
    return [None if null else i for i, null in zip(doc_ids, nulls)], lengths, ranks, before


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of its text with the end id, as little-endian unsigned numbers of two or four bytes."""
    kind = "<u2" if Encoder(path).size <= 1 << 16 else "<u4"

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, path):
            data = [np.frombuffer(d, "<u4").astype(kind).tobytes() for d in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "ids"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids binary")
    return materialize(found).withColumn("kind", F.lit(kind))


def _joined(column: pa.Array) -> memoryview:
    """The bytes of all values of a binary column, one after the other."""
    width = "<i8" if pa.types.is_large_binary(column.type) else "<i4"
    ends = np.frombuffer(column.buffers()[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize)
    return memoryview(column.buffers()[2] or b"")[int(ends[0]) : int(ends[-1])]


def ranked_ids(tokens: DataFrame, size: int) -> list[int]:
    """All ids below ``size``, most frequent first: counts over the whole corpus, one number per id on the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for kind in set(batch.column("kind").to_pylist()):
                total += np.bincount(np.frombuffer(_joined(batch.column("ids")), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = tokens.select("ids", "kind").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_id = dict(map(tuple, counts.collect()))
    return sorted(range(size), key=lambda i: (-by_id.get(i, 0), i))


def write_tokens(docs: DataFrame, folder: str | None = None, path: str | None = None) -> str:
    """Write all texts' ids in ascending doc_id order; returns the folder."""
    path = path or vocabulary()
    folder = folder or shared_folder(docs.sparkSession)
    tokens = token_ids(docs, path)
    by_rank = ranked_ids(tokens, Encoder(path).size)
    rank_of = np.empty(len(by_rank), "<u4")
    rank_of[by_rank] = np.arange(len(by_rank))
    listed = Writing(f"{folder}/ranks")
    listed.write(np.array(by_rank, "<u4").tobytes())
    listed.finish()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, before = TaskContext.get().partitionId(), 0, 0
        held: tuple[list, list, list] = ([], [], [])
        names = ["part", "file", "documents", "ids"]

        def flush() -> pa.RecordBatch:
            nonlocal files, before
            ranks = rank_of[np.concatenate(held[2])]
            file = Writing(f"{folder}/part-{part:05d}-{files:05d}.tmrk")
            file.write(encode_file(held[0], held[1], ranks, before))
            file.finish()
            row = [part, files, len(held[0]), len(ranks)]
            files, before = files + 1, before + len(ranks)
            for column in held:
                column.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names)

        ids_held = 0
        for batch in batches:
            for doc_id, data, kind in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "kind"))):
                ids = np.frombuffer(data, kind)
                for column, value in zip(held, (doc_id, len(ids), ids)):
                    column.append(value)
                ids_held += len(ids)
                if ids_held >= FILE_IDS:
                    yield flush()
                    ids_held = 0
        if held[0]:
            yield flush()

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(write, "part long, file long, documents long, ids long").write.parquet(f"{folder}/manifest")
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in the files: doc_id, start (ids before it in all files), ids (uint32 bytes), n_tokens."""
    source = reading(f"{folder}/ranks")
    by_rank = np.frombuffer(source.read(), "<u4")
    source.close()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist()):
                content = reading(f"{folder}/part-{part:05d}-{file:05d}.tmrk").read()
                doc_ids, lengths, ranks, before = decode_file(content)
                data = by_rank[ranks].tobytes()
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                columns = [
                    pa.array([part] * len(doc_ids), pa.int64()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + before, pa.int64()),
                    pa.array([data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                ]
                whole = pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "inside", "ids"])
                yield from (whole.slice(i, 4096) for i in range(0, whole.num_rows, 4096))

    manifest = spark.read.parquet(f"{folder}/manifest")
    totals = manifest.groupBy("part").agg(F.sum("ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("part", "file").repartition(partitions, "part", "file")
    found = files.mapInArrow(read, "part long, doc_id long, inside long, ids binary")
    joined = found.join(bounded_broadcast(materialize(bases)), "part")
    return joined.select(
        "doc_id",
        (F.col("base") + F.col("inside")).alias("start"),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
    )


def digest(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` in place of the ids."""
    return tokens.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")

"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: its words hashed to ``2 ** BITS`` places (weight ``1 + ln tf``, the words' part of length 1), and
dense statistics of its structure and metadata (standardised over the examples). The score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

the last sum taken in linear time as half of ``(sum_i v_i x_i)^2 - sum_i (v_i x_i)^2`` per factor. It is fitted in one task
on a bounded sample of labelled rows, weighted back to the shares of the classes, and applied to every whole text.

Null and empty texts have no words and zero statistics. Null metadata counts as 0. Without a labelled text of both classes
every score is the share of label 1, or 0. Labels, language, source and id are no inputs; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.llm.learning import PER_CLASS, held_out, labelled

BITS, FACTORS, EPOCHS = 16, 8, 12
METADATA = ("n_chars",)
_RATE, _SHRINK = 0.02, 1e-4
_WORD = re.compile(r"\w+")
_REMEMBERED = 300_000
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[ord(c) for c in " \t"]] = 4
_CLASS[ord("\n")] = 5
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 6
_CLASS[ord("!")] = 7
_CLASS[128:] = 8
_CLASSES = 9


def structure(text: str, words: list[str], distinct: int) -> list[float]:
    """Statistics of a text's form."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return [0.0] * STATISTICS
    counts = np.bincount(data, minlength=256)
    shares = np.bincount(_CLASS, counts, _CLASSES) / len(data)
    lines = text.split("\n")
    full = [line for line in lines if line.strip()]
    repeated = 1.0 - len(set(full)) / len(full) if full else 0.0
    runs = float((data[1:] == data[:-1]).mean()) if len(data) > 1 else 0.0
    return [
        *shares.tolist(),
        float(np.log1p(len(data))),
        float(np.log1p(len(lines))),
        len(data) / len(lines) ** 0.5 / 100.0,
        sum(map(len, words)) / len(words) if words else 0.0,
        distinct / len(words) if words else 0.0,
        repeated,
        runs,
        float(counts[ord("|")] / len(data)),
        float(counts[ord("#")] + counts[ord("%")] + counts[ord("&")] + counts[ord("*")] + counts[ord("$")]) / len(data),
        float(text[:1].isupper()),
        float(text.rstrip()[-1:] in (".", "!", "?")),
    ]


STATISTICS = _CLASSES + 11


class Featurizer:
    """Places and weights of a text's words, and its dense statistics."""

    def __init__(self, bits: int = BITS):
        self._mask = (1 << bits) - 1
        self._known: dict[str, int] = {}

    def __call__(self, text: str | None, metadata: list) -> tuple[np.ndarray, np.ndarray, list[float]]:
        text = text or ""
        words = _WORD.findall(text.lower())
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        distinct = set(words)
        for word in distinct.difference(known):
            known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & self._mask
        places = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        places, counts = np.unique(places, return_counts=True)
        weights = 1.0 + np.log(counts)
        if len(weights):
            weights /= np.sqrt((weights * weights).sum())
        values = [float(np.log1p(abs(v))) if v is not None else 0.0 for v in metadata]
        return places, weights, structure(text, words, len(distinct)) + values


class Machine:
    """A factorisation machine; dense features have the first places."""

    def __init__(self, dense: int, bits: int = BITS, factors: int = FACTORS, seed: int = 7):
        size = dense + (1 << bits)
        self.dense = dense
        self.bias = 0.0
        self.linear = np.zeros(size, np.float32)
        self.factors = (0.01 * np.random.default_rng(seed).standard_normal((size, factors))).astype(np.float32)
        self.mean, self.scale = np.zeros(dense), np.ones(dense)

    def row(self, features: tuple[np.ndarray, np.ndarray, list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """One vector: places and values."""
        places, weights, dense = features
        scaled = np.clip((np.array(dense) - self.mean) / self.scale, -5, 5) / np.sqrt(self.dense)
        return np.concatenate([np.arange(self.dense), places + self.dense]), np.concatenate([scaled, weights])

    def raw(self, places: np.ndarray, values: np.ndarray) -> tuple[float, np.ndarray]:
        """The score before the logistic, and the sum of weighted factors."""
        rows = self.factors[places] * values[:, None]
        total = rows.sum(0)
        pairs = 0.5 * float((total * total - (rows * rows).sum(0)).sum())
        return self.bias + float(self.linear[places] @ values) + pairs, total

    def score(self, features) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(*self.row(features))[0], -500, 500))))

    def fit(self, rows: list, targets: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """AdaGrad over single rows in an order that depends on ``seed`` alone."""
        dense = np.array([features[2] for features in rows])
        self.mean, self.scale = dense.mean(0), dense.std(0) + 1e-6
        vectors = [self.row(features) for features in rows]
        seen_linear, seen_factors, seen_bias = np.full(len(self.linear), 1e-3), np.full(self.factors.shape, 1e-3), 1e-3
        random = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in random.permutation(len(vectors)):
                places, values = vectors[i]
                score, total = self.raw(places, values)
                slope = weights[i] * (1.0 / (1.0 + np.exp(-np.clip(score, -500, 500))) - targets[i])
                step = slope * values + _SHRINK * self.linear[places]
                seen_linear[places] += step * step
                self.linear[places] -= _RATE * 5 * step / np.sqrt(seen_linear[places])
                rows_ = self.factors[places]
                step = slope * values[:, None] * (total - rows_ * values[:, None]) + _SHRINK * rows_
                seen_factors[places] += step * step
                self.factors[places] -= _RATE * step / np.sqrt(seen_factors[places])
                seen_bias += slope * slope
                self.bias -= _RATE * 5 * slope / np.sqrt(seen_bias)


def _features(batch: pa.RecordBatch, featurizer: Featurizer, metadata: tuple[str, ...]) -> Iterator:
    columns = [batch.column(name).to_pylist() for name in metadata]
    for text, *values in zip(batch.column("text").to_pylist(), *columns):
        yield featurizer(text, values)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", metadata: tuple[str, ...] = METADATA, per_class: int = PER_CLASS):
    """The machine fitted to the sample, or the share of label 1 if only one class is there."""
    known = labelled(docs, labels, target, per_class)
    sizes = {row.target: row.n / row.share for row in known.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.first("share").alias("share")).collect()}
    if len(sizes) < 2:
        return float(max(sizes, default=0))
    values = [F.col(name).cast("double").alias(name) for name in metadata]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *values).join(F.broadcast(known), "doc_id")
    # A row that is there a million times is one text of the sample.
    texts = texts.dropDuplicates(["doc_id"])

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer()
        for batch in batches:
            rows = list(_features(batch, featurizer, metadata))
            kinds = (pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
            lists = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            columns = [batch.column("doc_id"), batch.column("target"), batch.column("share"), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "target", "share", "places", "weights", "dense"])

    schema = "doc_id long, target int, share double, places array<long>, weights array<double>, dense array<double>"
    reduced = materialize(texts.mapInArrow(reduce, schema))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        columns = ["doc_id", "target", "share", "places", "weights", "dense"]
        rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns))]
        rows.sort(key=lambda row: (row[0], row[1]))
        targets = np.array([row[1] for row in rows], np.float64)
        weights = np.array([1.0 / row[2] for row in rows])
        machine = Machine(STATISTICS + len(metadata))
        features = [(np.array(r[3], np.int64), np.array(r[4]), r[5]) for r in rows]
        machine.fit(features, targets, weights / weights.mean())
        state = pickle.dumps(vars(machine))
        yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["machine"])

    import pickle

    # At most about PER_CLASS rows of each class, as sparse vectors: one task.
    machine = Machine(STATISTICS + len(metadata))
    vars(machine).update(pickle.loads(reduced.coalesce(1).mapInArrow(learn, "machine binary").first()[0]))
    return machine


def scored(docs: DataFrame, labels: DataFrame, target: str = "quality", metadata: tuple[str, ...] = METADATA, per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, score."""
    model = fit(docs, labels, target, metadata, per_class)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer()
        for batch in batches:
            if isinstance(model, float):
                scores = [model] * batch.num_rows
            else:
                scores = [model.score(features) for features in _features(batch, featurizer, metadata)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    values = [F.col(name).cast("double").alias(name) for name in metadata]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *values)
    return texts.mapInArrow(score, "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rated = scored(docs, labels)
    return rated.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))

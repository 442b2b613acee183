"""Language identification with bit-sliced Bloom filters of character n-grams.

All languages share one table of positions; a position holds a word of bits, one per language. An n-gram's bits are set at
several hashed positions in every language that has it, so that the AND of those positions gives at once all languages
that contain it. A text's n-grams are looked up together and each language's bits are counted; a filter with a part ``p`` of
its bits set answers wrongly with chance ``p ** probes``, so that a count ``c`` of ``n`` stands for ``(c - n q) / (1 - q)``
with that chance ``q``. The language with the largest corrected count is taken, of equal ones the first by name; the score is
its part of all corrected counts.

A language's n-grams (3 and 4 letters, words bounded by one blank) are all those of a bounded sample of its texts. One that is
more than twice as common in another language counts half: some foreign words in some texts don't make it a language's own.
The others are in a second table besides, and both counts are added. A null text or one without letters has the language ``und`` and the score 0. A text without any known n-gram gets the
first language and an even share; without anything to learn from every text is ``und``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.llm.learning import held_out, sampled

# Texts of a language that are learnt from, at most about.
PER_LANGUAGE = 1_024
SIZES = (3, 4)
# Positions of a table at least, and for each n-gram of the language that has most.
POSITION_BITS, ROOM, PROBES = 20, 8, 3
_COMMON = 0.5
UNKNOWN = "und"
_U = np.uint64
_STEPS = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9))
_BLANK = 0x20
_PLANE = 0x10000


class Grams:
    """Hashed n-grams of texts."""

    def __init__(self):
        self._letters = np.fromiter((chr(i).isalpha() for i in range(_PLANE)), bool, _PLANE)

    def letters(self, text: str | None) -> np.ndarray:
        """Code points of a text in lower case, each run of anything but letters as one blank, blanks around; or none."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
        low = points < _PLANE
        known = self._letters[np.where(low, points, 0)] & low
        for i in np.flatnonzero(~low).tolist():
            known[i] = chr(points[i]).isalpha()
        if not known.any():
            return np.zeros(0, "<u4")
        padded = np.concatenate([[_BLANK], np.where(known, points, _BLANK), [_BLANK]])
        return padded[np.concatenate([[True], (padded[1:] != _BLANK) | (padded[:-1] != _BLANK)])]

    def hashes(self, text: str | None) -> np.ndarray:
        points = self.letters(text).astype(_U)
        out = []
        for size in SIZES:
            n = len(points) - size + 1
            if n > 0:
                found = np.full(n, _U(size))
                for i in range(size):
                    found = (found ^ points[i : n + i]) * _STEPS[0]
                    found ^= found >> _U(29)
                out.append(found)
        return np.concatenate(out) if out else np.zeros(0, _U)


def positions(grams: np.ndarray, bits: int = POSITION_BITS) -> list[np.ndarray]:
    found = []
    for step in _STEPS[:PROBES]:
        mixed = (grams ^ (grams >> _U(32))) * step
        found.append((mixed >> _U(64 - bits)).astype(np.int64))
    return found


class Filters:
    """Bloom filters of several languages, side by side."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.languages = sorted(grams)
        self.words = -(-len(self.languages) // 64)
        self.size = max(POSITION_BITS, (ROOM * max(map(len, grams.values()), default=0)).bit_length())
        self.bits = np.zeros((max(1, self.words), 1 << self.size), _U)
        for i, language in enumerate(self.languages):
            for at in positions(grams[language], self.size):
                self.bits[i // 64][at] |= _U(1 << i % 64)
        filled = [((self.bits[i // 64] >> _U(i % 64)) & _U(1)).mean() for i in range(len(self.languages))]
        self.wrong = np.array(filled) ** PROBES

    def containing(self, grams: np.ndarray) -> list[np.ndarray]:
        """For each n-gram the bits of all languages that contain it, 64 languages to a word."""
        places = positions(grams, self.size)
        out = []
        for bits in self.bits:
            found = bits[places[0]]
            for at in places[1:]:
                found &= bits[at]
            out.append(found)
        return out

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Corrected number of n-grams in each language."""
        words = self.containing(grams)
        hits = np.array([int(((words[i // 64] >> _U(i % 64)) & _U(1)).sum()) for i in range(len(self.languages))], float)
        return np.maximum((hits - len(grams) * self.wrong) / (1.0 - self.wrong), 0.0)

    def decide(self, grams: np.ndarray, own: Filters | None = None) -> tuple[str, float]:
        """The language and its score; ``own``: the same languages' own n-grams, which count twice."""
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        counts = self.counts(grams)
        if own is not None:
            counts = counts + own.counts(grams)
        total = counts.sum()
        best = int(counts.argmax())
        return self.languages[best], float(counts[best] / total) if total else 1.0 / len(self.languages)


def fit(docs: DataFrame, folds: int = 4, out: int = 2, per_language: int = PER_LANGUAGE) -> tuple[Filters, Filters]:
    """Filters of the languages of rows whose id isn't held out: of all their n-grams, and of their own ones."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(folds, out)
    )
    # The share is one of ids, however many rows they have.
    known = known.select("doc_id", "lang").distinct()
    chosen = materialize(sampled(known, "lang", per_language).select("doc_id", "lang"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    # A row that is there a million times is one text of the sample.
    texts = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            held: dict[str, list] = {}
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(language, []).append(np.unique(grams.hashes(text)))
            for language, parts in held.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                columns = [pa.array([language] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counts = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    texts_of = dict(map(tuple, chosen.groupBy("lang").agg(F.count(F.lit(1))).collect()))
    sizes = docs.sparkSession.createDataFrame(list(texts_of.items()), "lang string, texts long")
    # As of one text more without it: a single text says little about a language.
    share = F.col("n") / (F.col("texts") + 1)
    own = share >= _COMMON * F.max(share).over(Window.partitionBy("gram"))
    # As many as the sample has: in columns, as rows would take many times the room.
    found = counts.join(F.broadcast(sizes), "lang").select("lang", "gram", own.alias("own")).toArrow()
    every, owned = {}, {}
    for language in texts_of:
        mine = found.filter(pc.equal(found.column("lang"), language))
        every[language] = mine.column("gram").to_numpy().view(_U)
        owned[language] = every[language][mine.column("own").to_numpy()]
    return Filters(every), Filters(owned)


def identified(docs: DataFrame, folds: int = 4, out: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    filters, own = fit(docs, folds, out)

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            rows = [filters.decide(grams.hashes(text), own) for text in batch.column("text").to_pylist()]
            columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(decide, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(folds, out).alias("held_out"), "lang_pred", "score")

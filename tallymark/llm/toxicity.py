"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted lists.

**Terms** are the words of a text and the 4- and 5-character pieces of its words (a word begins with ``^``). A document's
vector has all terms that occur in an example; document frequencies, and so the weights ``(1 + ln tf) * ln(1 + N / df)``,
cover all documents, and vectors are brought to length 1 as a whole. Texts meet in the terms whose share differs between
toxic and other labelled texts beyond chance, however many those are: only these are listed, and add to a cosine.

**Examples** are a bounded sample of labelled texts, in order of their heaviest term and cut into blocks. A term's list
holds its examples' weights by block, and the greatest weight in each block. For a document the greatest weights bound the
cosine of any example in a block; blocks are opened from the highest bound on and the search ends when no bound exceeds
the k-th best cosine found, so that the neighbours are exact (of equal ones, those in earlier blocks).

**Scores.** Neighbours vote with their cosine, weighted for how much of their class the sample holds; a vote for the share
among examples without any term is added, so that a text without terms gets that share. A logistic curve fitted on the
examples' own scores (each without itself) makes scores probabilities. The nearest examples are the evidence.

Null and empty texts have no terms. A text without a term that tells the classes apart has no neighbours. Without a labelled text of both classes every score is the share of toxic ones, or 0.
Labels, language, source and id are no inputs. Rows may repeat; other columns are ignored or, in ``rejected``, kept.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize, shared_folder
from tallymark.llm.learning import PER_CLASS, held_out, labelled

NEIGHBOURS = 15
EVIDENCE = 3
BLOCK = 64
# Blocks opened before the others are judged by their bounds.
_FIRST = 4
# Where more than one block in so many is left to open, whole lists are added up.
_WIDE = 4
# Terms count whose shares differ between the classes by this many deviations (the root of the likelihood ratio).
_DEVIATIONS = 4.0
_PRIOR_VOTE = 0.25
_PIECES = (4, 5)
_WORD = re.compile(r"[^\W\d_]+")
# Of the first 256 characters the letters, and spaces for all others.
_LETTERS = bytes(c if _WORD.fullmatch(chr(c)) else 32 for c in range(256))
_REMEMBERED = 200_000
# Words whose terms are put in order at a time.
_WORDS = 50_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    lower = (text or "").lower()
    try:
        return lower.encode("latin-1").translate(_LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(lower)


def word_terms(word: str) -> list[str]:
    marked = "^" + word
    pieces = {marked[i : i + n] for n in _PIECES for i in range(len(marked) - n + 1)}
    return [f"{marked}$", *sorted(pieces)]


class Terms:
    """Counts of terms in texts."""

    def __init__(self):
        self._known: dict[str, list] = {}

    def counts(self, text: str | None) -> Counter:
        words = words_of(text)
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = word_terms(word)
        return Counter(itertools.chain.from_iterable(map(known.__getitem__, words)))


def _found(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted table, -1 for those that aren't there."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Pieces:
    """Exact lookup of all pieces of many words at once.

    Two letters have a number, two such numbers are a piece of four, and that with a letter is a piece of five.
    """

    def __init__(self, terms: list[str]):
        pieces = [(t, i) for i, t in enumerate(terms) if len(t) in _PIECES and not t.endswith("$")]
        codes = [np.frombuffer("".join(t[:4] for t, _ in pieces).encode("utf-32-le"), "<u4").astype(np.int64).reshape(-1, 4)]
        first, second = (codes[0][:, i] << 21 | codes[0][:, i + 1] for i in (0, 2))
        self._twos = np.unique(np.concatenate([first, second]))
        four = _found(self._twos, first) << 32 | _found(self._twos, second)
        self._fours = np.unique(four)
        number = np.array([i for _, i in pieces], np.int64)
        long = np.array([len(t) for t, _ in pieces], np.int64)
        place = _found(self._fours, four)
        self._four_terms = np.full(len(self._fours), -1, np.int64)
        self._four_terms[place[long == 4]] = number[long == 4]
        last = np.array([ord(t[4]) for t, _ in pieces if len(t) == 5], np.int64)
        five = place[long == 5] << 21 | last
        order = np.argsort(five)
        self._fives, self._five_terms = five[order], number[long == 5][order]

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of a word and that of a term, for every known piece in ``words``; a piece may come twice."""
        # Nothing known has the separator in it.
        codes = np.frombuffer("".join(f"^{w}\0" for w in words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
        two = _found(self._twos, codes[:-1] << 21 | codes[1:])
        at = np.flatnonzero((two[:-2] >= 0) & (two[2:] >= 0))
        four = _found(self._fours, two[at] << 32 | two[at + 2])
        at, four = at[four >= 0], four[four >= 0]
        longer = at[at + 4 < len(codes)]
        five = _found(self._fives, four[: len(longer)] << 21 | codes[longer + 4])
        words_of = np.concatenate([word[at], word[longer[five >= 0]]])
        terms = np.concatenate([self._four_terms[four], self._five_terms[five[five >= 0]]])
        return words_of[terms >= 0], terms[terms >= 0]


class Numbered:
    """Counts of known terms, as numbers, in many texts at once."""

    def __init__(self, terms: pa.Array):
        listed = terms.to_pylist()
        self._size = len(listed)
        self._words = {term[1:-1]: i for i, term in enumerate(listed) if term.endswith("$")}
        self._pieces = Pieces(listed)
        self._forget()

    def _forget(self) -> None:
        #: The place of each word, and where its terms begin and end among all words' terms.
        self._places: dict[str, int] = {}
        self._starts, self._listed = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        self._places.update(zip(words, range(len(self._places), len(self._places) + len(words))))
        word, term = self._pieces.of(words)
        whole = np.fromiter((self._words.get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(whole >= 0)
        keys = np.sort(np.concatenate([word, known]) * self._size + np.concatenate([term, whole[known]]))
        word, term = np.divmod(keys[np.diff(keys, prepend=-1) > 0], max(self._size, 1))
        ends = len(self._listed) + np.cumsum(np.bincount(word, minlength=len(words)))
        self._listed, self._starts = np.concatenate([self._listed, term]), np.concatenate([self._starts, ends])

    def counts(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each run of texts its begin and end, and texts (from the begin on), terms and counts in order of both."""
        said, long, begin = [], [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            said.extend(words)
            long.append(len(words))
            if len(said) >= _WORDS or i + 1 == len(texts):
                self._learn(list(set(said).difference(self._places)))
                places = np.fromiter(map(self._places.__getitem__, said), np.int64, len(said))
                yield begin, i + 1, *self._ordered(places, np.array(long))
                said, long, begin = [], [], i + 1
                if len(self._places) > _REMEMBERED:
                    self._forget()

    def _ordered(self, said: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, listed = self._starts, self._listed
        pairs, times = np.unique(np.repeat(np.arange(len(long)), long) * len(starts) + said, return_counts=True)
        at, word = np.divmod(pairs, len(starts))
        sizes = starts[word + 1] - starts[word]
        places = np.repeat(starts[word] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        n = self._size + 1
        keys = np.repeat(at, sizes) * n + listed[places]
        order = np.argsort(keys)
        keys, times = keys[order], np.repeat(times, sizes)[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        at, term = np.divmod(keys[first], n)
        return at, term, np.add.reduceat(times, first) if len(first) else times


def chosen_terms(texts: DataFrame, classes: dict[int, int]) -> tuple[pa.Array, int]:
    """All terms of ``texts`` (text, target), and how many of them, which come first, tell the two classes apart."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        terms = Terms()
        for batch in batches:
            for text, target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist()):
                found[target].update(set(terms.counts(text)))
        every = list(found[0].keys() | found[1].keys())
        for start in range(0, len(every), 50_000):
            part = every[start : start + 50_000]
            columns = [pa.array(part), *(pa.array([c[t] for t in part], pa.int64()) for c in found)]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n0", "n1"])

    rows = texts.select("text", "target").mapInArrow(count, "term string, n0 long, n1 long")
    sums = rows.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    share = (F.col("n0") + F.col("n1")) / (classes[0] + classes[1])

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = sum(
        part(F.col(n), size * share) + part(size - F.col(n), size * (1 - share)) for n, size in (("n0", classes[0]), ("n1", classes[1]))
    )
    z = F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    # As many as the sample has: in columns, as rows would take many times the room.
    rated = sums.select("term", F.when(z >= _DEVIATIONS, z).otherwise(0.0).alias("z"), (F.col("n0") + F.col("n1")).alias("n")).toArrow()
    # The steps between small numbers are short: frequent terms have those.
    rated = rated.sort_by([("z", "descending"), ("n", "descending"), ("term", "ascending")])
    return rated.column("term").combine_chunks(), int(np.count_nonzero(rated.column("z").to_numpy()))


def _key(doc_id: str | Column, text: str | Column) -> Column:
    """What tells rows apart that have one doc_id, or none."""
    return F.xxhash64(doc_id, text)


def _planes(numbers: np.ndarray) -> bytes:
    """How many bytes the greatest of ``numbers`` takes, then the lowest bytes of all, the next ones, and so on."""
    size = 1 + sum(int(numbers.max(initial=0)) > most for most in (0xFF, 0xFFFF, 0xFFFFFF))
    return bytes([size]) + numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :size].T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    size = planes[0]
    out = np.zeros(((len(planes) - 1) // size, 4), np.uint8)
    out[:, :size] = np.frombuffer(planes, np.uint8, offset=1).reshape(size, -1).T
    return out.view("<u4").reshape(-1).astype(np.int64)


def cut(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """doc_id, doc_key, steps, counts of every text: which of ``terms`` it has, as steps from each to the next, and how often.

    Texts are cut this once; their frequencies, lengths and weights come from what is written here.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Numbered(shared.value)
        for batch in batches:
            for begin, end, at, term, times in found.counts(batch.column("text").to_pylist()):
                ends = np.searchsorted(at, np.arange(end - begin + 1))
                steps = np.diff(term, prepend=0)
                firsts = ends[:-1][np.diff(ends) > 0]
                steps[firsts] = term[firsts]
                lists = [pa.array([_planes(x[i:j]) for i, j in itertools.pairwise(ends.tolist())], pa.binary()) for x in (steps, times)]
                ids = [batch.column(name).slice(begin, end - begin) for name in ("doc_id", "doc_key")]
                yield pa.RecordBatch.from_arrays([*ids, *lists], ["doc_id", "doc_key", "steps", "counts"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("doc_key", _key("doc_id", "text"))
    written = texts.mapInArrow(count, "doc_id long, doc_key long, steps binary, counts binary")
    folder = shared_folder(docs.sparkSession)
    written.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(written.schema).parquet(folder)


def _tallied(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, n = 0, np.zeros(size, np.int64)
        for batch in batches:
            texts += batch.num_rows
            for steps in batch.column("steps"):
                # No term comes twice in a text.
                n[np.cumsum(_numbers(steps.as_py()))] += 1
        there = np.flatnonzero(n)
        columns = [pa.array(np.append(there, -1), pa.int32()), pa.array(np.append(n[there], texts))]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    each = texts.select("steps").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    # The number of texts has the number -1, and so the last place.
    out[each.column("term").to_numpy()] = each.column("n").to_numpy()
    return out[:-1], int(out[-1])


def frequencies(docs: DataFrame, terms: pa.Array) -> tuple[np.ndarray, int]:
    """In how many texts of ``docs`` each of ``terms`` occurs, and how many texts there are."""
    return _tallied(cut(docs, terms), len(terms))


def _weighed(batch: pa.RecordBatch, kept: int, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Of each written text the first ``kept`` terms, their counts, and how long the vector of all its terms is."""
    for steps, counts in zip(batch.column("steps"), batch.column("counts")):
        term, times = np.cumsum(_numbers(steps.as_py())), _numbers(counts.as_py())
        weights = (1.0 + np.log(times)) * idf[term]
        n = int(np.searchsorted(term, kept))
        yield term[:n], times[:n], math.sqrt(float(weights @ weights))


def _listed(texts: DataFrame, kept: int, idf: np.ndarray) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_weighed(batch, kept, shared.value))
            lists = [pa.array([row[i] for row in rows], pa.list_(pa.int32())) for i in (0, 1)]
            columns = [batch.column("doc_id"), batch.column("doc_key"), *lists, pa.array([row[2] for row in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_key", "terms", "counts", "length"])

    return texts.mapInArrow(weigh, "doc_id long, doc_key long, terms array<int>, counts array<int>, length double")


def counted(docs: DataFrame, terms: pa.Array, kept: int, idf: np.ndarray) -> DataFrame:
    """doc_id, doc_key, terms, counts, length: of every text the first ``kept`` terms, and how long the vector of all its terms is."""
    return _listed(cut(docs, terms), kept, idf)


def weighted(terms: list[int], counts: list[int], idf: np.ndarray, length: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A text's terms and their weights, for a vector of ``length`` (of these terms alone if it is None) brought to 1."""
    at = np.array(terms, np.int64)
    weights = (1.0 + np.log(np.array(counts, np.float64))) * idf[at]
    size = math.sqrt(float((weights * weights).sum())) if length is None else length
    return at, weights / size if size else weights


class BlockMax:
    """Inverted lists of examples in blocks, with each block's greatest weight of each term."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        heaviest = [int(t[w.argmax()]) for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (heaviest[i], i)), np.int64)
        self.block = block
        self.blocks = -(-len(vectors) // block)
        rows = [vectors[i] for i in self.order]
        place = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows]).astype(np.int64)
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in rows]) if rows else np.zeros(0)
        by_term = np.lexsort((place, term))
        self.place, self.weight, term = place[by_term], weight[by_term], term[by_term]
        cell = term * self.blocks + self.place // block
        #: Where the list of a term goes on in each block.
        self.starts = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def _scores(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact cosines of the examples in ``blocks`` that share a term."""
        cells = terms[:, None] * self.blocks + blocks
        starts, ends = self.starts[cells].reshape(-1), self.starts[cells + 1].reshape(-1)
        long = ends - starts
        listed = np.repeat(starts - (np.cumsum(long) - long), long) + np.arange(long.sum())
        parts = self.weight[listed] * np.repeat(np.repeat(weights, len(blocks)), long)
        total = np.bincount(self.place[listed], parts, len(self.order))
        found = np.flatnonzero(total > 0)
        return found, total[found]

    def _every_score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of all blocks, from whole lists."""
        ends = self.starts[np.stack([terms, terms + 1], 1) * self.blocks].tolist()
        place = np.concatenate([self.place[i:j] for i, j in ends])
        parts = np.concatenate([self.weight[i:j] * w for (i, j), w in zip(ends, weights.tolist())])
        total = np.bincount(place, parts, len(self.order))
        found = np.flatnonzero(total > 0)
        return found, total[found]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of greatest positive cosine, as numbers of ``vectors``, and the cosines.

        The blocks of the highest bounds are opened first; the k-th best cosine in them says which others can matter.
        """
        bounds = weights @ self.most[terms]
        blocks = np.argsort(-bounds, kind="stable")
        blocks = blocks[bounds[blocks] > 0]
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        for opened in (blocks[:_FIRST], blocks[_FIRST:]):
            if len(scores) >= k:
                # Sums in another order may differ in the last digits.
                opened = opened[bounds[opened] >= np.partition(scores, -k)[-k] - 1e-12]
            if not len(opened):
                continue
            every = _WIDE * len(opened) > self.blocks
            found, cosines = self._every_score(terms, weights) if every else self._scores(terms, weights, opened)
            kept = self.order[found] != without
            if every:
                places, scores = found[kept], cosines[kept]
                break
            places, scores = np.concatenate([places, found[kept]]), np.concatenate([scores, cosines[kept]])
        if len(scores) > k:
            near = scores >= np.partition(scores, -k)[-k]
            places, scores = places[near], scores[near]
        best = np.lexsort((places, -scores))[:k]
        return self.order[places[best]], scores[best]


class Model:
    """Examples, their votes and the curve that makes a score of them."""

    def __init__(self, examples: list, idf: np.ndarray, shares: dict[int, float], k: int = NEIGHBOURS):
        """``examples``: (doc_id, terms, counts, length, target) rows; ``shares``: the part of each class that they are."""
        self.idf, self.k = idf, k
        #: Those of the terms that aren't listed too, which a text's length needs.
        self.every_idf = idf
        examples = sorted(examples, key=lambda e: (e[0], e[4]))
        weight = {target: 1.0 / share for target, share in shares.items()}
        total = sum(weight[e[4]] for e in examples)
        self.base = sum(weight[e[4]] for e in examples if e[4] == 1) / total if examples else 0.0
        with_terms = [e for e in examples if len(e[1])]
        bare = [e for e in examples if not len(e[1])]
        outside = sum(weight[e[4]] for e in bare)
        self.bare = sum(weight[e[4]] for e in bare if e[4] == 1) / outside if bare else self.base
        self.ids = np.array([e[0] for e in with_terms], np.int64)
        self.targets = np.array([e[4] for e in with_terms], np.float64)
        mean = total / len(examples) if examples else 1.0
        self.weights = np.array([weight[e[4]] / mean for e in with_terms])
        vectors = [weighted(*e[1:3], idf, e[3]) for e in with_terms]
        self.index = BlockMax(vectors, len(idf))
        own = [self._vote(*self.index.nearest(t, w, k, i)) for i, (t, w) in enumerate(vectors)] + [self.bare] * len(bare)
        rows = [(e[4], weight[e[4]]) for e in with_terms + bare]
        self.curve = _logistic(np.array(own), rows) if len({t for t, _ in rows}) == 2 else None

    def _vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        votes = cosines * self.weights[examples]
        toxic = float((votes * self.targets[examples]).sum()) + _PRIOR_VOTE * self.bare
        return toxic / (float(votes.sum()) + _PRIOR_VOTE)

    def score(self, terms: list[int], counts: list[int], length: float) -> tuple[float, list[int]]:
        """The score of a text, and the ids of the nearest examples."""
        if self.curve is None:
            return self.base, []
        examples, cosines = np.zeros(0, np.int64), np.zeros(0)
        if len(terms) and len(self.ids):
            examples, cosines = self.index.nearest(*weighted(terms, counts, self.idf, length), self.k)
        slope, middle = self.curve
        score = 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, slope * self._vote(examples, cosines) + middle))))
        return score, self.ids[examples[:EVIDENCE]].tolist()


def _logistic(x: np.ndarray, rows: list[tuple[int, float]]) -> tuple[float, float]:
    """Slope and height of the weighted logistic fit of targets to ``x``, with a little shrinkage."""
    y = np.array([t for t, _ in rows], np.float64)
    w = np.array([v for _, v in rows])
    w = w / w.mean()
    design = np.stack([x, np.ones(len(x))], 1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -500, 500)))
        gradient = design.T @ (w * (y - p)) - 1e-3 * at
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS) -> tuple[Model, DataFrame]:
    """The model, and the terms of every document as :func:`cut` wrote them."""
    known = labelled(docs, labels, target, per_class)
    shares = dict(map(tuple, known.groupBy("target").agg(F.first("share")).collect()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    # Copies of a text would make its words look like a class's: each text counts once.
    texts = materialize(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash", "target"]).select("text", "target"))
    sizes = dict(map(tuple, texts.groupBy("target").agg(F.count(F.lit(1))).collect()))
    terms, kept = chosen_terms(texts, sizes) if len(sizes) == 2 else (pa.array([], pa.string()), 0)
    written = cut(docs, terms)
    n, every = _tallied(written, len(terms))
    idf = np.log1p(every / np.maximum(n, 1))
    met = _listed(written.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi"), kept, idf)
    examples = met.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    examples = examples.select("doc_id", "terms", "counts", "length", "target")
    model = Model([tuple(row) for row in examples.collect()], idf[:kept], shares)
    model.every_idf = idf
    return model, written


def scored(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, doc_key, score, evidence (ids of the nearest examples)."""
    model, found = fit(docs, labels, target, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = shared.value
            rows = [model.score(*row) for row in _weighed(batch, len(model.idf), model.every_idf)]
            columns = [pa.array([s for s, _ in rows], pa.float64()), pa.array([e for _, e in rows], pa.list_(pa.int64()))]
            ids = [batch.column(name) for name in ("doc_id", "doc_key")]
            yield pa.RecordBatch.from_arrays([*ids, *columns], ["doc_id", "doc_key", "score", "evidence"])

    return found.mapInArrow(score, "doc_id long, doc_key long, score double, evidence array<long>")


def predictions(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence."""
    rated = scored(docs, labels)
    return rated.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), "evidence")


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` without those whose text scores ``least`` or more, whatever their doc_id."""
    toxic = scored(docs, labels).filter(F.col("score") >= least).select("doc_key", "doc_id").distinct()
    doc_id = F.col("d.doc_id").cast("long")
    met = (_key(doc_id, F.col("d.text")) == F.col("x.doc_key")) & doc_id.eqNullSafe(F.col("x.doc_id"))
    return docs.alias("d").join(toxic.alias("x"), met, "left_anti")

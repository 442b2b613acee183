from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallymark.llm import language, quality, toxicity
from tallymark.llm.common import fold

from tests.llm.samples import docs, frame, prose

LABELS = "doc_id long, quality int, toxic int"


def labels(spark, rows):
    return frame(spark, rows, LABELS)


def corpus(n=600):
    rows, marks = [], []
    pick = random.Random(2)
    for i in range(n):
        toxic, good = i % 7 == 0, i % 3 != 0
        words = prose(i, 60).split()
        if toxic:
            words[pick.randrange(60)] = pick.choice(["vilezorq", "vilezorqs", "grimlux"])
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text))
        marks.append((i, int(good), int(toxic)))
    return rows, marks


ODD = [(5000, None), (5001, ""), (5002, "... 123"), (None, "vilezorq here"), (5003, prose(1, 20_000)), (7, "repeated id")]


def test_fold(spark):
    rows = spark.createDataFrame([(0,), (17,), (-3,), (None,)], "doc_id long").select("doc_id", fold("doc_id", 5).alias("f"))
    for r in rows.collect():
        assert r.f == zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5


def check(rows, marks, got, least):
    by_id = {}
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= least)
        by_id.setdefault(r.doc_id, r)
    assert len(got) == len(rows)
    out = [i for i, m in marks.items() if by_id[i].held_out]
    assert len(out) > 50
    return np.mean([by_id[i].predicted == marks[i] for i in out])


def test_toxicity(spark):
    rows, marks = corpus()
    got = toxicity.predictions(docs(spark, rows + ODD), labels(spark, marks + [(1, None, None), (14, 0, 1)])).collect()
    known = {i: t for i, _, t in marks if i != 7}
    assert check(rows + ODD, known, got, 0.5) > 0.97
    toxic = next(r for r in got if r.doc_id == 14)
    assert toxic.evidence and set(toxic.evidence) <= {i for i, _, t in marks if t}
    kept = toxicity.accepted(docs(spark, rows + ODD), labels(spark, marks))
    assert kept.columns == docs(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, t in known.items() if not t} - {r.doc_id for r in got if r.predicted}


def test_held_out_labels_change_nothing(spark):
    rows, marks = corpus(200)
    out = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    other = [(i, 1 - q, 1 - t) if i in out else (i, q, t) for i, q, t in marks]
    for predictions in (toxicity.predictions, quality.predictions):
        one, two = (sorted((r.doc_id, r.score) for r in predictions(docs(spark, rows), labels(spark, m)).collect()) for m in (marks, other))
        assert one == two


def test_nearest_neighbours_are_exact():
    pick = np.random.default_rng(5)
    idf = pick.random(40) + 0.5
    vectors = []
    for _ in range(500):
        terms = np.sort(pick.choice(40, pick.integers(1, 9), replace=False))
        vectors.append(toxicity.weighted(terms.tolist(), (1 + pick.integers(0, 5, len(terms))).tolist(), idf))
    dense = np.zeros((500, 40))
    for row, (terms, weights) in zip(dense, vectors):
        row[terms] = weights
    index = toxicity.BlockMax(vectors, 40, block=16)
    for i in range(0, 500, 7):
        ids, cosines = index.nearest(*vectors[i], 15, without=i)
        every = dense @ dense[i]
        every[i] = -1
        assert np.allclose(np.sort(every)[::-1][: len(cosines)], cosines)
        assert np.allclose(every[ids], cosines)
        assert len(cosines) == min(15, int((every > 0).sum()))


def test_neighbours_are_the_same_from_cells_and_from_whole_lists(monkeypatch):
    pick = np.random.default_rng(6)
    vectors = []
    for _ in range(400):
        terms = np.sort(pick.choice(60, pick.integers(1, 40), replace=False))
        vectors.append(toxicity.weighted(terms.tolist(), (1 + pick.integers(0, 5, len(terms))).tolist(), np.ones(60)))
    found = []
    for wide, block in ((0, 16), (4, 16), (10**9, 16), (4, 50), (0, 50)):
        monkeypatch.setattr(toxicity, "_WIDE", wide)
        index = toxicity.BlockMax(vectors, 60, block=block)
        found.append([index.nearest(*vectors[i], 15, i)[1] for i in range(0, 400, 9)])
    assert all(len(a) == len(b) and np.allclose(a, b) for one in found[1:] for a, b in zip(found[0], one))


def test_every_term_that_tells_the_classes_apart_counts(spark):
    pick = random.Random(4)
    slurs = ["".join(pick.choice("bdfghjkpqvwxyz") + pick.choice("aeiou") for _ in range(5)) for _ in range(150)]
    rows = [(i, prose(i, 20)) for i in range(900)]
    rows += [(1000 + i, f"{prose(i, 12)} {' '.join(slurs[(i * 9 + k) % 150] for k in range(9))}") for i in range(200)]
    marks = [(i, None, int(i >= 1000)) for i, _ in rows]
    asked = [(2000 + i, f"{prose(5000 + i, 8)} {slur} {slur}") for i, slur in enumerate(slurs)]
    got = {r.doc_id: r for r in toxicity.predictions(docs(spark, rows + asked), labels(spark, marks)).collect()}
    assert all(got[i].predicted and got[i].evidence for i, _ in asked)


def test_lengths_are_those_of_all_terms(spark):
    terms = ["^vile$", "^vil", "vile", "^vile", "^bane$", "^ban", "bane", "^bane"]
    rows = [(1, "vile bane bane other"), (2, "bane"), (3, None), (4, "VILE")]
    n, every = toxicity.frequencies(docs(spark, rows), pa.array(terms))
    assert (n.tolist(), every) == ([2] * 8, 4)
    idf = np.log1p(every / n)
    got = {r.doc_id: r for r in toxicity.counted(docs(spark, rows), pa.array(terms), 4, idf).collect()}
    assert [(got[i].terms, got[i].counts) for i in (1, 2, 3, 4)] == [([0, 1, 2, 3], [1] * 4), ([], []), ([], []), ([0, 1, 2, 3], [1] * 4)]
    want = [2 * np.sqrt(1 + (1 + np.log(2)) ** 2), 2, 0, 2]
    assert np.allclose([got[i].length for i in (1, 2, 3, 4)], np.array(want) * idf[0])


def test_numbered_terms_are_those_of_plain_counts():
    texts = [prose(i, 40) for i in range(30)] + ["", None, "a", "ab abc abcd", "aaaaaaa aaaaaaa", "Caf\u00e9_\u00df \u00aa\xa0x\x00y \u0130stanbul"]
    texts += ["\u65e5\u672c\u8a9e\u306e\u30c6\u30ad\u30b9\u30c8 \U00020000\U00020001\U00020002\U00020003\U00020004 word", prose(7, 3000)]
    plain = toxicity.Terms()
    assert all(toxicity.words_of(t) == toxicity._WORD.findall((t or "").lower()) for t in texts)
    for known in (sorted({t for text in texts[::2] for t in plain.counts(text)}), ["^vile", "^a$", "aaaa"], []):
        numbers = {t: i for i, t in enumerate(known)}
        got = [{} for _ in texts]
        for begin, _, at, term, times in toxicity.Numbered(pa.array(known, pa.string())).counts(texts):
            for a, t, n in zip(at.tolist(), term.tolist(), times.tolist()):
                got[begin + a][t] = n
        assert got == [{numbers[t]: n for t, n in plain.counts(text).items() if t in numbers} for text in texts]


def test_written_terms_are_those_of_plain_counts(spark):
    rows = [(i, prose(i, 30)) for i in range(40)] + [(100, None), (101, ""), (102, "vile " * 70_000), (None, "vile"), (5, "vile bane")]
    plain = toxicity.Terms()
    known = sorted({t for _, text in rows[::3] for t in plain.counts(text)} | {"^vile$", "vile"})
    numbers = {t: i for i, t in enumerate(known)}
    got = sorted(
        (str(r.doc_id), list(zip(np.cumsum(toxicity._numbers(r.steps)).tolist(), toxicity._numbers(r.counts).tolist())))
        for r in toxicity.cut(docs(spark, rows), pa.array(known)).collect()
    )
    assert got == sorted((str(i), sorted((numbers[t], n) for t, n in plain.counts(text).items() if t in numbers)) for i, text in rows)


def test_scores_are_those_of_all_examples_compared(spark):
    """Every row's score again: counts, cosines with all examples, votes and curve, without lists and bounds."""
    rows, marks = corpus(400)
    rows = rows + [r for r in ODD if r[0] != 7]
    model, _ = toxicity.fit(docs(spark, rows), labels(spark, marks))
    known = sorted((i, t) for i, _, t in marks if zlib.crc32(str(i).encode()) % 5)
    plain, by_id = toxicity.Terms(), dict(rows[:400])
    seen = [plain.counts(text) for _, text in rows]
    texts = {(by_id[i], t) for i, t in known}
    every = {t for i, _ in known for t in plain.counts(by_id[i])}
    idf = {t: np.log1p(len(rows) / n) for t, n in Counter(t for c in seen for t in c if t in every).items()}
    sizes = {c: len([1 for _, t in texts if t == c]) for c in (0, 1)}
    having = {c: Counter(term for x, t in texts if t == c for term in plain.counts(x)) for c in (0, 1)}

    def tells(term):
        share, ratio = sum(having[c][term] for c in (0, 1)) / sum(sizes.values()), 0.0
        for c in (0, 1):
            for n, p in ((having[c][term], share), (sizes[c] - having[c][term], 1 - share)):
                ratio += n * np.log(n / (sizes[c] * p)) if n else 0.0
        return 2 * ratio >= 16.0

    kept = {t for t in every if tells(t)}

    def vector(counts):
        whole = {t: (1 + np.log(n)) * idf[t] for t, n in counts.items() if t in every}
        length = np.sqrt(sum(w * w for w in whole.values()))
        return {t: w / length for t, w in whole.items() if t in kept}

    examples = [(vector(plain.counts(by_id[i])), t) for i, t in known]
    outside = [t for v, t in examples if not v]
    bare = sum(outside) / len(outside) if outside else sum(t for _, t in examples) / len(examples)
    slope, middle = model.curve
    got = {r.doc_id: r.score for r in toxicity.scored(docs(spark, rows), labels(spark, marks)).collect()}
    assert len(got) == len(rows)
    for (i, _), counts in zip(rows, seen):
        mine = vector(counts)
        near = sorted(((sum(w * v.get(t, 0.0) for t, w in mine.items()), t) for v, t in examples), key=lambda x: -x[0])
        near = [x for x in near[: toxicity.NEIGHBOURS] if x[0] > 0]
        vote = (sum(c * t for c, t in near) + 0.25 * bare) / (sum(c for c, _ in near) + 0.25)
        assert np.isclose(got[i], 1 / (1 + np.exp(-(slope * vote + middle))), rtol=1e-6)


def test_each_row_is_accepted_by_its_own_text(spark):
    rows, marks = corpus()
    odd = [(None, "vilezorq grimlux vilezorq"), (None, prose(9000, 60) + "."), (1, "vilezorq grimlux vilezorq"), (14, prose(9001, 60) + ".")]
    odd += [(None, None), (8000, None)]
    table = docs(spark, rows + odd)
    kept = {(r.doc_id, r.text) for r in toxicity.accepted(table, labels(spark, [m for m in marks if m[0] not in (1, 14)])).collect()}
    assert [row in kept for row in odd] == [False, True, False, True, True, True]
    assert rows[1] in kept and rows[14] not in kept


def test_quality(spark):
    rows, marks = corpus()
    got = quality.predictions(docs(spark, rows + ODD), labels(spark, marks)).collect()
    assert check(rows + ODD, {i: q for i, q, _ in marks if i != 7}, got, 0.3) > 0.97


def test_factorisation_identity():
    machine = quality.Machine(3, bits=6, factors=4)
    machine.linear[:] = np.random.default_rng(1).standard_normal(len(machine.linear))
    places, values = np.array([0, 1, 2, 9, 40]), np.array([0.5, -1.0, 2.0, 0.25, 0.75])
    want = machine.bias + float(machine.linear[places] @ values)
    for i in range(5):
        for j in range(i):
            want += float(machine.factors[places[i]] @ machine.factors[places[j]]) * values[i] * values[j]
    assert abs(machine.raw(places, values)[0] - want) < 1e-5


def test_nothing_to_learn_from(spark):
    rows = ODD + [(1, "a text")]
    for predictions in (toxicity.predictions, quality.predictions):
        for marks in ([], [(1, 1, 1)], [(1, None, None)]):
            got = predictions(docs(spark, rows), labels(spark, marks)).collect()
            assert len(got) == len(rows) and len({r.score for r in got}) == 1
        assert predictions(docs(spark, []), labels(spark, [(1, 1, 1)])).count() == 0


SPEECH = {"aa": "ba ne to ri", "bb": "xy qu vo zi", "cc": "ба не ло ми"}


def speech(spark, odd):
    rows = [(i, prose(i, 30, SPEECH[lang]), lang, None, None) for i in range(240) for lang in [sorted(SPEECH)[i % 3]]]
    return rows + odd, frame(spark, rows + odd)


def test_language(spark):
    odd = [
        (900, None, "aa", None, None),
        (901, "", "bb", None, None),
        (902, "12 ... \U0001f600", None, None, None),
        (903, "bane tori", None, None, None),
        (None, "xyqu vozi", None, None, None),
        (904, prose(1, 20_000, SPEECH["cc"]), "aa", None, None),
        (0, "quvo", "cc", None, None),
        (905, "\U00010400\U00010401", None, None, None),
    ]
    rows, table = speech(spark, odd)
    got = language.identified(table).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}
    for i in (900, 901, 902):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[903].lang_pred == "aa" and found[None].lang_pred == "bb" and found[904].lang_pred == "cc"
    assert found[905].lang_pred in SPEECH and all(0.0 <= r.score <= 1.0 for r in got)
    out = [r for r in got if r.held_out and r.doc_id is not None and 0 < r.doc_id < 240]
    assert len(out) > 30 and all(r.lang_pred == sorted(SPEECH)[r.doc_id % 3] for r in out)


def test_repeated_rows_leave_the_sample_of_a_language_whole(spark):
    rows = [(i, prose(i, 5, SPEECH[lang]), lang, None, None) for i in range(60) for lang in [sorted(SPEECH)[i % 3]]]
    rows += [(rows[0][0], rows[0][1], "aa", None, None)] * 3000
    filters = language.fit(frame(spark, rows), per_language=16)[0]
    assert filters.languages == sorted(SPEECH)
    assert filters.decide(language.Grams().hashes(prose(1, 40, SPEECH["aa"])))[0] == "aa"
    aa, bb, _ = (np.count_nonzero(filters.bits[0] & np.uint64(1 << i)) for i in range(3))
    assert aa > bb / 3


def test_every_ngram_of_the_sample_is_in_its_filter(spark):
    letters = [chr(0x4E00 + i) for i in range(24_000)]
    rows = [(i, prose(i, 30, SPEECH["aa"]), "aa", None, None) for i in range(40)]
    rows += [(1, prose(7, 30, SPEECH["bb"]), "bb", None, None), (3, " ".join(letters), "cc", None, None)]
    # Foreign words in a language that has more of them elsewhere.
    rows += [(i, prose(i, 30, SPEECH["cc"]) + " bane" * (i == 101), "dd", None, None) for i in range(100, 140)]
    assert {1, 3, 101}.isdisjoint(i for i in range(140) if zlib.crc32(str(i).encode()) % 4 == 2)
    table = frame(spark, rows)
    filters, own = language.fit(table)
    grams = language.Grams()
    for text, name in ((rows[40][1], "bb"), (rows[41][1], "cc"), ("bane", "dd")):
        i = filters.languages.index(name)
        assert all((w >> np.uint64(i)) & np.uint64(1) for w in filters.containing(np.unique(grams.hashes(text)))[0])
    assert own.decide(grams.hashes("bane"))[0] == "aa" == filters.decide(grams.hashes("bane"), own)[0]
    asked = frame(spark, [(900, rows[40][1], None, None, None), (901, " ".join(letters[::-1]), None, None, None)])
    got = {r.doc_id: r.lang_pred for r in language.identified(table.union(asked)).collect()}
    assert got[900] == "bb" and got[901] == "cc"


def test_language_without_anything_to_learn(spark):
    table = docs(spark, [(1, "words")]).withColumn("lang", F.lit(None).cast("string"))
    assert [tuple(r)[2:] for r in language.identified(table).collect()] == [("und", 0.0)]
    assert language.identified(docs(spark, [])).count() == 0


def test_more_languages_than_a_word_has_bits():
    pick = np.random.default_rng(3)
    grams = {f"l{i:03d}": pick.integers(0, 1 << 63, 50).astype(np.uint64) for i in range(70)}
    filters = language.Filters(grams)
    for name in ("l000", "l063", "l064", "l069"):
        assert filters.decide(grams[name])[0] == name

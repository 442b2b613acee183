from __future__ import annotations

import numpy as np
import pytest

from tallymark.llm import minhash

from tests.llm.samples import docs, prose


def expected(rows, least=0.8):
    shingler = minhash.Shingler()
    sets = [shingler.weighted(t) if i is not None else (np.zeros(0), np.zeros(0)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a][0]) and len(sets[b][0]) and minhash.similarity(sets[a], sets[b]) >= least:
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((i, root(i) if i is not None else None) for i, _ in rows), key=repr)


def edited(text, every, seed):
    words = text.split()
    for at in range(seed % every, len(words), every):
        words[at] = f"edit{seed}x{at}"
    return " ".join(words)


BASE = prose(5, 200)
ROWS = [
    *[(i, edited(BASE, 60, i)) for i in range(10, 60)],
    (7, BASE),
    (70, BASE),
    (71, BASE + "\n"),
    (72, edited(BASE, 5, 3)),
    (100, None),
    (101, ""),
    (102, "..."),
    (103, "..."),
    (104, "one two"),
    (105, "One, two!"),
    (None, BASE),
    (106, prose(9, 20_000)),
    (107, prose(9, 20_000) + " tail"),
    (108, "same words " * 400),
    (109, "same words " * 400),
    (110, "same words " * 4),
    (111, prose(11, 50)),
    (111, prose(12, 50)),
    (112, prose(12, 50)),
    (5, prose(11, 50)),
    (200, prose(31, 60)),
    (200, prose(32, 60)),
    (201, prose(32, 60) + " more"),
    (202, prose(31, 60) + " more"),
]


def test_same_classes_as_brute_force(spark):
    found = minhash.classes(docs(spark, ROWS)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=repr) == expected(ROWS)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in found)


def test_buckets_of_several_components(spark, monkeypatch):
    # Chains: neighbours are near copies, the ends are not, so that the first comparison of a bucket fails for many.
    words = prose(21, 300).split()
    rows = [(i, " ".join(words[: 200 - 7 * i] + [f"z{i}x{k}" for k in range(7 * i)])) for i in range(12)]
    monkeypatch.setattr(minhash, "BLOCK", 3)
    got = sorted(((r.doc_id, r.class_id) for r in minhash.classes(docs(spark, rows)).collect()), key=repr)
    assert got == expected(rows)


def test_signatures_estimate_the_weighted_similarity():
    shingler = minhash.Shingler()
    for every in (20, 60, 200):
        sets = [shingler.weighted(t) for t in (BASE * 3, edited(BASE * 3, every, 1))]
        rows = minhash.signatures(sets, 2048)
        assert float((rows[0] == rows[1]).mean()) == pytest.approx(minhash.similarity(*sets), abs=0.05)


def test_deduplicated_keeps_columns_and_one_of_each_class(spark):
    table = docs(spark, ROWS)
    kept = minhash.deduplicated(table)
    assert kept.columns == table.columns
    want = sorted((i for i, c in expected(ROWS) if i is None or i == c), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_empty_table(spark):
    assert minhash.classes(docs(spark, [])).count() == 0

from __future__ import annotations

import re

from tallymark.llm import decontaminate

from tests.llm.samples import docs, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def expected(rows, items):
    out = []
    for doc_id, text in rows:
        words, hit, ids = split(text), set(), set()
        for item_id, item in items:
            parts = split(item)
            n = min(10, len(parts))
            for start in range(len(parts) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == parts[start : start + n]:
                        hit.update(range(at, at + n))
                        ids.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def found(spark, rows, items):
    benchmark = frame(spark, items, "item_id long, text string")
    table = decontaminate.contamination(docs(spark, rows), benchmark)
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in table.collect()), key=repr
    )


LONG = prose(1, 40)
ITEMS = [(1, LONG), (10, LONG), (2, "Ünïcode wörds, short"), (3, None), (4, "!!"), (5, "the"), (None, prose(7, 15)), (6, prose(8, 10))]
ROWS = [
    (1, LONG),
    (2, "Before " + LONG.upper() + " after"),
    (3, " ".join(LONG.split()[5:15])),
    (4, " ".join(LONG.split()[5:14])),
    (5, "ünïcode WÖRDS short and Ünïcode wörds... ünïcode wörds"),
    (6, None),
    (7, ""),
    (8, "?!\x00 \n"),
    (9, "The THE the other"),
    (9, prose(8, 10) + " x " + prose(7, 15)),
    (9, prose(8, 10) + " x " + prose(7, 15)),
    (None, LONG),
    (11, prose(3, 30_000) + " " + LONG),
    (12, " ".join(reversed(LONG.split()))),
    (13, (LONG + " ") * 3),
]


def test_same_as_brute_force(spark):
    assert found(spark, ROWS, ITEMS) == expected(ROWS, ITEMS)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, ROWS[:3], []) == expected(ROWS[:3], [])


def test_near_matches_in_any_order(spark):
    benchmark = frame(spark, [(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(1, "gamma x beta alpha"), (2, "gamma y y y y y y y y y y y y y beta alpha")]
    index = decontaminate.build_index(docs(spark, rows), benchmark, window=3, slack=1)
    assert {r.doc_id for r in decontaminate.near_matches(index).collect()} == {1}
    assert decontaminate.phrase_matches(index).count() == 0


def test_clean_documents_keep_columns(spark):
    table = docs(spark, ROWS)
    clean = decontaminate.clean_documents(table, frame(spark, ITEMS, "item_id long, text string"))
    assert clean.columns == table.columns
    want = sorted((r[0] for r in expected(ROWS, ITEMS) if not r[4]), key=repr)
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == want


def test_no_python_in_the_plan(spark):
    benchmark = frame(spark, ITEMS, "item_id long, text string")
    plan = decontaminate.contamination(docs(spark, ROWS), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_long_items_in_proportion_to_their_windows(spark):
    long = prose(21, 20_000)
    parts = long.split()
    rows = [(1, long), (2, "x " + " ".join(parts[7_000:7_500]) + " y"), (2, "x " + " ".join(parts[7_000:7_500]) + " y"), (3, prose(22, 500)), (None, long)]
    got = found(spark, rows, [(1, long), (2, " ".join(parts[:12]))])
    windows = {tuple(parts[i : i + 10]) for i in range(len(parts) - 9)}

    def hit(text):
        words, out = split(text), set()
        for i in range(len(words) - 9):
            if tuple(words[i : i + 10]) in windows:
                out.update(range(i, i + 10))
        return len(out)

    assert sorted((repr(r[0]), r[1], r[2]) for r in got) == sorted((repr(i), len(split(t)), hit(t)) for i, t in rows)
    assert [r[3] for r in got if r[0] in (1, None)] == [["1", "2"], ["1", "2"]]


def test_same_matches_without_broadcasts(spark, monkeypatch):
    index = decontaminate.build_index(docs(spark, ROWS), frame(spark, ITEMS, "item_id long, text string"))
    plain = decontaminate.bounded_broadcast

    def matches():
        return sorted(repr((r.doc_id, r.doc_key, sorted(r.item_ids), r.hits)) for r in decontaminate.phrase_matches(index).collect())

    sent = matches()
    monkeypatch.setattr(decontaminate, "bounded_broadcast", lambda df, text=None, limit=0: plain(df, text, 0))
    assert sent and matches() == sent

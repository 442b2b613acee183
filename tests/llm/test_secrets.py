from __future__ import annotations

import re

from tallymark.llm import secrets
from tallymark.llm.common import shared_folder

from tests.llm.samples import docs

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))


def expected(text):
    out = []
    for nth, (kind, pattern, group, least) in enumerate(KINDS):
        out += [(m.start(), nth, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(out)


KEY = "AKIA" + "Z9" * 8
TEXTS = [
    None,
    "",
    "nothing here",
    "password=abcdefghijkl",
    "éé PassWord\" : 'short' and token = sésame secret: 0123456789abcdef0 end",
    f"{KEY} x {KEY[:17]} AKIAAKIA{KEY} \U0001f600 {KEY}",
    "token=secret=abcdefghijklmnop api_key:abcabcabcabc apikey='0123456789abcdef0123456789abcdef'",
    "token: password: abcdefghijklmnop",
    "deadbeef" * 20_000,
    ("secret=" + "x" * 12 + " ") * 300,
    "0123456789abcdeF 0123456789abcdef",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (90, TEXTS[4]), (None, TEXTS[3]), (91, TEXTS[3])]


def spans(row):
    return [tuple(s) for s in row.secret_spans]


def test_same_as_brute_force(spark):
    found = secrets.scan(docs(spark, ROWS)).collect()
    got = sorted(((r.doc_id, r.text, spans(r)) for r in found), key=repr)
    assert got == sorted(((i, t, expected(t)) for i, t in ROWS), key=repr)


def test_only_unseen_pairs_are_scanned(spark):
    path = shared_folder(spark)
    secrets.update_ledger(docs(spark, ROWS[:6]), path)
    first = secrets.read_ledger(spark, path).count()
    assert first == 3 * len({t or "" for _, t in ROWS[:6]})
    secrets.update_ledger(docs(spark, ROWS[:6]), path)
    assert secrets.read_ledger(spark, path).count() == first
    secrets.update_ledger(docs(spark, ROWS), path)
    assert secrets.read_ledger(spark, path).count() == 3 * len({t or "" for _, t in ROWS})
    newer = (secrets.RULES[0], secrets.Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18, version=2), secrets.RULES[2])
    before = secrets.read_ledger(spark, path).count()
    found = secrets.scan(docs(spark, ROWS), path, newer).collect()
    assert secrets.read_ledger(spark, path).count() == before + len({t or "" for _, t in ROWS})
    assert sorted((spans(r) for r in found), key=repr) == sorted((expected(t) for _, t in ROWS), key=repr)


def test_redaction(spark):
    table = docs(spark, ROWS)
    out = secrets.redact(table)
    assert out.columns == table.columns
    by_id = {r.doc_id: r.text for r in out.collect()}
    for i, text in enumerate(TEXTS):
        if not expected(text):
            assert by_id[i] == text
            continue
        want, at = "", 0
        for start, _, _, end in expected(text):
            if start >= at:
                want += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert by_id[i] == want + text[at:]


def test_empty_table(spark):
    assert secrets.scan(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = secrets.scan(docs(spark, ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|Cartesian|NestedLoop", plan)

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallymark.llm import mixing

from tests.llm.samples import DOCS, frame, prose


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while len(full) < len(order):
        rate = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and rate * weight[s] > most * sizes[s]}
        if not more:
            break
        full |= more
    return {s: most * sizes[s] if s in full else rate * weight[s] for s in order}


def expected(rows, **options):
    sizes = Counter()
    groups = defaultdict(list)
    for i, text, _, source, _ in rows:
        sizes[source] += size(text)
        content = hashlib.md5((text or "").encode()).hexdigest()
        key = int(hashlib.sha256(f"1:{'' if i is None else i}:{content}".encode()).hexdigest()[:15], 16)
        groups[source].append((key, content, i, size(text)))
    wanted = targets(sizes, **options) if rows else {}
    out = []
    for source, docs in groups.items():
        budget, before = math.floor(wanted[source]), 0
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for _, _, i, n in sorted(docs, key=lambda d: d[:2]):
            out.append((i, n, sizes[source], round(wanted[source], 6), epochs * n + min(max(rest - before, 0), n)))
            before += n
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in mixing.taken(df, **options).collect()), key=repr)


def rows_of(n=120):
    made = [(i, prose(i, 1 + i * 7 % 40), "en", f"src{i % 4}" if i % 3 else "src0", 1) for i in range(n)]
    odd = [
        (500, None, None, None, None),
        (501, "", None, "", None),
        (502, " \t\n\x0b\x0c\r ", None, "only gaps", None),
        (503, "a b c\x1cd", None, None, None),
        (None, "no id", None, "src1", None),
        (None, "no id", None, "src1", None),
        (None, "no id either", None, None, None),
        (504, "w " * 30_000, None, "\U0001f600", None),
        (505, "x" * 200_000, None, "￮", None),
    ]
    return made + odd + [(7, "the same row", "en", "src2", 1)] * 60


def test_same_as_brute_force(spark):
    rows = rows_of()
    assert found(frame(spark, rows).repartition(5)) == expected(rows)


@pytest.mark.parametrize("options", [{"share": 0.3}, {"share": 3.0}, {"weights": (1,), "share": 1.0}, {"share": 2.0}, {"share": 2.7, "most": 3}])
def test_shares(spark, options):
    rows = rows_of(40)
    assert found(frame(spark, rows), **options) == expected(rows, **options)


def test_targets_are_met_and_runs_agree(spark):
    rows = rows_of()
    df = frame(spark, rows)
    first, second = found(df), found(df.repartition(7, "n_chars"))
    assert first == second
    assert all(0 <= r[4] <= 2 * r[1] for r in first)
    taken = Counter()
    for r in first:
        taken[r[2], r[3]] += r[4]
    assert all(got == math.floor(target) for (_, target), got in taken.items())


def test_seed_changes_what_is_taken(spark):
    df = frame(spark, rows_of()[:120])
    one, two = (sorted(map(tuple, mixing.taken(df, share=0.5, seed=seed).select("doc_id", "taken").collect())) for seed in (1, 2))
    assert one != two and sum(n for _, n in one) == sum(n for _, n in two)


def test_hot_row_fills_many_ranges(spark):
    rows = [(1, "hot row", "en", "s", 7)] * 3_000 + [(i, prose(i, 5), "en", "s", 1) for i in range(2, 300)]
    assert found(frame(spark, rows, clashing=False).repartition(6)) == expected(rows)


def test_empty(spark):
    assert found(frame(spark, [])) == []
    assert mixing.mixed(frame(spark, [])).collect() == []
    rows = [(1, "", None, "a", 0), (2, None, None, None, 0)]
    assert found(frame(spark, rows)) == expected(rows)


def test_mixed_rows_have_the_words_that_are_taken(spark):
    rows = rows_of()
    df = frame(spark, rows)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    words = Counter()
    for r in mixed.select("doc_id", "source", "text").collect():
        words[r.doc_id, r.source] += size(r.text)
        whole = [t for i, t, _, s, _ in rows if i == r.doc_id and s == r.source]
        assert r.text in whole or any(" ".join(re.findall(r"[^\x20\x09-\x0D]+", t)).startswith(r.text) for t in whole)
    plan = mixing.taken(df.select(*[c.split()[0] for c in DOCS.split(", ")])).groupBy("doc_id").agg(F.sum("taken").alias("n"))
    total = Counter()
    for (i, _), n in words.items():
        total[i] += n
    assert {r.doc_id: r.n for r in plan.collect() if r.n} == dict(total)

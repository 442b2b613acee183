from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

from tallymark.llm import manifest

from tests.llm.samples import frame, prose


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    i, _, lang, source, n = row
    fields = [None if f is None else str(f) for f in (i, source, lang, n, text)]
    return sha(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def tree(hashes):
    """The last node, and for every leaf its siblings level by level as (left, right)."""
    ways = [[] for _ in hashes]
    at, level = list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, way in enumerate(ways):
            run, p = runs[at[k] // 3], at[k] % 3
            way.append((run[:p], run[p + 1 :]))
            at[k] //= 3
        level = [sha(*run) for run in runs]
    return level[0], ways


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    placed, subroots = {}, []
    for source in sources:
        docs = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        subroot, ways = tree([leaf(r, r[1]) for r in docs])
        subroots.append(subroot)
        placed[source] = (docs, subroot, ways)
    if not rows:
        return []
    root, above = tree(subroots)
    out = []
    for k, source in enumerate(sources):
        docs, subroot, ways = placed[source]
        for row, way in zip(docs, ways):
            path = way + above[k]
            even = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0
            h = leaf(row, row[1].replace("\n", "") if even and row[1] is not None else row[1])
            for left, right in path:
                h = sha(*left, h, *right)
            proof = sha(*[x for left, right in path for x in left + right])
            out.append((row[0], leaf(row, row[1]), subroot, root, proof, h, h == root))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, manifest.audited(df).collect()), key=repr)


def rows_of(sizes):
    return [
        (1000 * s + i, prose(i, 1 + i % 5) + "\n" * (i % 3), "en", f"s{s:04}", i) for s, n in enumerate(sizes) for i in range(n)
    ]


ODD = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (None, "a\nb", None, None, 3),
    (5, "", "", "", 0),
    (6, "-", "-", "-", -1),
    (-7, "z\n" * 50_000, "fr", "\U0001f600", 100_000),
    (-8, "\n", "fr", "￮", 1),
    (3, "twice", "en", "s0001", 5),
    (3, "twice", "en", "s0001", 5),
    (3, "same id", "en", "s0001", 7),
]


def test_small_trees(spark):
    rows = rows_of([1, 2, 3, 4, 9, 10, 27, 28]) + ODD
    assert found(frame(spark, rows).repartition(4)) == expected(rows)


def test_deep_tree_and_rounds(spark):
    rows = rows_of([2200, 244, 243])
    assert found(frame(spark, rows, clashing=False).repartition(6)) == expected(rows)


def test_many_groups(spark):
    rows = rows_of([1 + k % 3 for k in range(260)])
    assert found(frame(spark, rows, clashing=False)) == expected(rows)


def test_one_group_one_row_and_none(spark):
    for rows in (rows_of([30]), rows_of([1]), []):
        assert found(frame(spark, rows)) == expected(rows)


def test_hot_row(spark):
    rows = [(1, "the same\nrow", "en", "s", 1)] * 900 + rows_of([40])
    assert found(frame(spark, rows, clashing=False).repartition(5)) == expected(rows)


def test_rows_per_join_key_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEAVES_PER_KEY", 16)
    rows = rows_of([800, 20])
    assert found(frame(spark, rows, clashing=False)) == expected(rows)


def test_proofs_of_other_fields(spark):
    df = frame(spark, rows_of([12, 5])).withColumnRenamed("doc_id", "number")
    made = manifest.proofs(df, fields=("number", "text"), key="number", group="lang", carried={"size": F.length("text")})
    rows = made.withColumn("again", manifest.folded(F.col("leaf"))).collect()
    assert len(rows) == 17 and all(r.again == r.root == r.subroot and r.size is not None for r in rows)

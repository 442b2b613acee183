from __future__ import annotations

import corpus_pipeline
from tallymark.llm import decontaminate, minhash, toxicity

from tests.llm.samples import DOCS, prose
from tests.llm.test_classifiers import LABELS, corpus
from tests.llm.test_decontaminate import expected as leaks
from tests.llm.test_minhash import edited
from tests.llm.test_secrets import KEY

LEAK = prose(77, 30)


def tables(spark, folder):
    rows, marks = corpus(300)
    long = prose(500, 400)
    rows += [(1000, long), (1001, edited(long, 100, 3)), (1002, long), (1003, prose(501, 50) + " " + LEAK)]
    rows += [(1004, f"key {KEY} and password=abcdefghijklmnop " + prose(502, 40)), (1005, None), (1006, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages_take_effect(spark, tmp_path):
    folder = f"file://{tmp_path}"
    rows = tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    texts = dict(rows)
    ids = set(texts)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == names, name
        path = f"{folder}/{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        got = {r.doc_id: r for r in docs.collect()}
        if k == 0:
            scored = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{folder}/labels.parquet"))
            ids -= {r.doc_id for r in scored.collect() if r.score >= 0.5}
            assert 1000 in ids and len(ids) < len(texts)
        elif k == 1:
            ids -= {1001, 1002}
        elif k == 2:
            ids -= {i for i, *_, hit in leaks(sorted((i, texts[i]) for i in ids), [(1, LEAK)]) if hit}
            assert 1003 not in ids
        else:
            assert KEY not in got[1004].text and "abcdefghijklmnop" not in got[1004].text
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
            assert all(r.text == texts[i] for i, r in got.items() if i != 1004)
        assert set(got) == ids, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == ids
    assert corpus_pipeline.run(spark, folder).count() == packed.count()


def test_clean_documents_stay(spark):
    rows = [(i, prose(900 + i, 80)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash.deduplicated(docs).count() == 60
    benchmark = spark.createDataFrame([(1, LEAK)], "item_id long, text string")
    assert decontaminate.clean_documents(docs, benchmark).count() == 60

"""Advantages and reports on streams against the batch."""

import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallymark.operators import eval_report, grade, group_advantage
from tallymark.operators.metrics import predicted_answers
from tallymark.streaming import advantage, advantage_stream, report_stream, running_rejects, running_report

START = datetime(2024, 1, 1)
SCHEMA = "id string, gen long, total_reward double, at timestamp"


def arrive(spark, folder, rows):
    spark.createDataFrame([(*r[:3], START + timedelta(minutes=r[3])) for r in rows], SCHEMA).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, **options):
    options = {"time": "at", "schema": SCHEMA, **options}
    advantage_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", **options).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    return sorted(((r.id, r.gen, r.total_reward, None if r.advantage is None else round(r.advantage, 9), r.reason) for r in rows), key=repr)


def batch(spark, rows):
    df = spark.createDataFrame([r[:3] for r in rows], "id string, gen long, total_reward double").distinct()
    return sorted(((r.id, r.gen, r.total_reward, None if r.advantage is None else round(r.advantage, 9)) for r in group_advantage(df).collect()), key=repr)


def test_same_as_batch_and_resent_rows_change_nothing(spark, tmp_path):
    rows = [(f"p{i}", g, [0.0, 1.0, 0.5, 1.01][(i * g) % 4], i) for i in range(30) for g in range(4)]
    rows += [("same", g, 1.0, 5) for g in range(4)] + [("null", g, None if g else 0.3, 5) for g in range(4)]
    for part in (rows[::3], rows[1::3], rows[::3], rows[2::3], rows[5:40]):
        arrive(spark, tmp_path / "in", part)
    found = run(spark, tmp_path, files_per_batch=3)
    assert [r[:4] for r in found] == batch(spark, rows)
    assert {r[4] for r in found} == {None}
    arrive(spark, tmp_path / "in", rows)
    assert run(spark, tmp_path) == found


def test_incomplete_late_and_lost_groups(spark, tmp_path):
    arrive(spark, tmp_path / "in", [("a", 0, 1.0, 0), ("a", 1, 0.0, 1), ("b", 0, 1.0, 0), (None, 0, 1.0, 0), (None, 0, 1.0, 0)])
    first = run(spark, tmp_path, delay=600)
    assert first == [(None, 0, 1.0, None, "no_group")] * 2
    arrive(spark, tmp_path / "in", [("b", g, float(g), 2) for g in range(5)])
    second = run(spark, tmp_path, delay=600)
    # Five completions came together with the one that was there: the first of each number counts.
    assert [r[:3] for r in second if r[0] == "b"] == [("b", 0, 1.0), ("b", 1, 1.0), ("b", 2, 2.0), ("b", 3, 3.0), ("b", 4, 4.0)]
    arrive(spark, tmp_path / "in", [("b", 9, 7.0, 3), ("b", 2, 2.0, 3), ("later", 0, 0.0, 120)])
    third = run(spark, tmp_path, delay=600)
    assert ("b", 9, 7.0, None, "late") in third
    wanted = 0.5 / (math.sqrt(0.5) + 1e-4)
    assert [r for r in third if r[0] == "a"] == [("a", 0, 1.0, round(wanted, 9), "incomplete"), ("a", 1, 0.0, round(-wanted, 9), "incomplete")]
    assert len(third) == len(second) + 3 and not any(r[0] == "later" for r in third)


def test_groups_of_one_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(advantage, "BUCKETS", 1, raising=False)
    test_incomplete_late_and_lost_groups(spark, tmp_path)


def test_python_is_called_by_the_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(advantage, "BUCKETS", 3, raising=False)
    rows = [(f"p{i}", (1 << 60) + g if g else None, [0.0, 1.0, None, 1.01][(i * g) % 4], i % 50) for i in range(200) for g in range(3)]
    arrive(spark, tmp_path / "in", rows + [(None, None, 0.5, 0)] + rows[:100])
    query = advantage_stream(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", time="at", schema=SCHEMA, generations=3
    )
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.gen, r.total_reward, r.advantage, r.reason) for r in found if r.id is None] == [(None, 0.5, None, "no_group")]
    known = [(r.id, r.gen, r.total_reward, None if r.advantage is None else round(r.advantage, 9)) for r in found if r.id is not None]
    assert sorted(known, key=repr) == batch(spark, rows)


def lines(spark, folder, rows):
    df = spark.createDataFrame(rows, "run string, id string, prompt_text string, generated string")
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(str(folder))


def test_report_of_runs(spark, tmp_path):
    truths = [(f"t{i}", rf"\frac{{{2 * i}}}{{2}}") for i in range(20)] + [("none", None)]
    dataset = spark.createDataFrame(truths, "id string, ground_truth string")
    answers = ["<answer>{}</answer>", "no answer {}", r"<answer>\frac{{{}}}{{1}}</answer>", "<answer>-1{}</answer>"]
    rows = [(f"run{r}", f"t{i}", "q", answers[(i + r) % 4].format(i)) for r in range(3) for i in range(20)]
    rows += [("run0", "none", "q", "<answer>1</answer>"), ("run1", "unknown", "q", "<answer>1</answer>")]
    for part in (rows[::2], rows[1::2]):
        lines(spark, tmp_path / "in", part)
    (tmp_path / "bad").mkdir()
    spark.createDataFrame([("not json",), ("",), ('{"run": "run0"}',)], "value string").write.mode("append").text(str(tmp_path / "in"))

    def go(state):
        report_stream(spark, f"{tmp_path}/in", dataset, f"{tmp_path}/ledger", f"{tmp_path}/{state}", 1).awaitTermination()
        return sorted(running_report(spark, f"{tmp_path}/ledger").collect())

    found = go("state")
    pairs = spark.createDataFrame(rows[:60], "run string, id string, prompt_text string, generated string")
    given = predicted_answers(pairs.withColumn("id", F.struct("id", "run"))).select("id.*", "predicted_answer")
    assert found == sorted(eval_report(grade(given.join(dataset, "id")), "run").collect())
    rejects = {r.run: (r.bad_lines, r.no_example, r.no_ground_truth) for r in running_rejects(spark, f"{tmp_path}/ledger").collect()}
    assert rejects == {None: (3, 0, 0), "run0": (0, 0, 1), "run1": (0, 1, 0), "run2": (0, 0, 0)}
    # Batches that run again, here all of them, replace their share.
    assert go("state again") == found

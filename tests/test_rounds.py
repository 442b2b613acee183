"""Rounds of grading against truths in buckets."""

import re
from uuid import uuid4

import pytest

from tallymark.plans import reduced_truths, score_rollouts, score_round, store_truths
from tests.test_plans import plan


@pytest.fixture
def stored_as(spark):
    name = f"truths_{uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def problems(spark, rows):
    return spark.createDataFrame(rows, "id string, ground_truth string")


def completions(spark, rows):
    return spark.createDataFrame(rows, "id string, gen long, completion string")


TRUTHS = [(f"p{i}", str(i)) for i in range(60)] + [("none", None), (None, "7"), ("hot", r"\frac{1}{2}")]
ROWS = [(f"p{i % 80}", i // 80, f"so <answer> {i % 7} </answer>") for i in range(400)]
ROWS += [("hot", g, "<answer>0.5</answer>" if g % 3 else "0.5") for g in range(300)] + [(None, g, "<answer>7</answer>") for g in range(200)]
ROWS += [("none", 0, "<answer>1</answer>"), ("p1", 99, None), ("p1", 99, None), ("p2", 99, ""), ("p3", 99, "<answer>3</answer>" * 5000)]


def test_a_round_scores_as_a_join_does(spark, stored_as, tmp_path):
    truth, rows = problems(spark, TRUTHS), completions(spark, ROWS)
    stored = store_truths(truth, stored_as, path=str(tmp_path / "truths"))
    want = sorted(map(str, score_rollouts(rows, truth).collect()))
    assert len(want) > 600
    for _ in range(2):
        got = score_round(rows, stored)
        assert sorted(map(str, got.select(score_rollouts(rows, truth).columns).collect())) == want
    none = completions(spark, [])
    assert score_round(none, stored).count() == 0


def test_truths_are_not_moved(spark, stored_as, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stored = store_truths(problems(spark, TRUTHS), stored_as, path=str(tmp_path / "truths"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(score_round(completions(spark, ROWS), stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "SelectedBucketsCount: 8 out of 8" in text
    moved = [block for block in re.findall(r"\) Exchange\n.*?\n\n", text, re.S) if "hashpartitioning(id" in block]
    truth = [name for name in stored.columns if name != "id"]
    assert len(moved) == 1 and not any(re.search(rf"[\[ ]{name}#", moved[0]) for name in truth)


def test_doubled_truths_are_an_error_and_empty_ones_are_not(spark, stored_as, tmp_path):
    with pytest.raises(Exception, match="more than one ground truth row for key p5"):
        store_truths(problems(spark, TRUTHS + [("p5", "5")]), stored_as, path=str(tmp_path / "doubled"))
    spark.sql(f"drop table if exists {stored_as}")
    empty = store_truths(problems(spark, []), stored_as, path=str(tmp_path / "empty"))
    assert empty.columns == reduced_truths(problems(spark, [])).columns
    assert score_round(completions(spark, ROWS), empty).count() == 0

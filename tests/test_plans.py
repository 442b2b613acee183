"""What the plans of the queries look like, and what they give."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from tallymark.functions.rewards import DEFAULT_REWARDS
from tallymark.plans import evaluate, score_rollouts
from tallymark.queries import ORACLES, QUERIES
from tallymark.queries.shared import MODEL, SPLIT, predictions, rl_samples, truths
from tallymark.fixtures import completions
from tallymark.operators import hot_keys
from tallymark.storage import materialize
from tests.oracle import TABLES, compare, connect

SF = str(TABLES / "sf0.01")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def outcomes(spark):
    """What differs between each query and its SQL; several queries at a time."""
    duck, queries, oracles = connect(SF), QUERIES, ORACLES

    def outcome(name):
        try:
            return compare(spark, duck.cursor(), SF, queries[name], oracles[name])
        except Exception as error:  # noqa: BLE001
            return repr(error)

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(queries, pool.map(outcome, queries)))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(outcomes, name):
    assert outcomes[name] == ""


@pytest.mark.parametrize("name", ["group_advantage", "evaluate", "prepare_sft", "join_images", "math_equal", "eval_report", "stable_index"])
def test_no_python_no_cross_join_no_single_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    for window in re.findall(r"\) Window.*?\n\n", text, re.S):
        assert "Arguments: [" in window and re.search(r"\], \[__range#", window)


def test_only_reduced_columns_are_shuffled(spark):
    """Completions are scored before the shuffle: their texts stay where they were read."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written, truth = materialize(completions(spark, SF)), materialize(truths(spark, SF))
        text = plan(score_rollouts(written, truth, DEFAULT_REWARDS, "idx", hot_keys(written, "idx")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = [block for block in re.findall(r"\) Exchange\n.*?\n\n", text, re.S) if "hashpartitioning(idx" in block and "__salt" in block]
    assert len(shuffled) == 2
    for block in shuffled:
        assert not re.search(r"[\[ ]completion#", block)


def test_report_needs_no_generated_texts(spark):
    """All that is graded once and written are answers and flags; samples alone fetch the texts."""
    done = evaluate(rl_samples(spark, SF), predictions(spark, SF), MODEL, None)
    assert not re.search(r"prediction[:#]|generated", plan(done.report))
    assert "prediction#" in plan(done.samples)


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(QUERIES["split_rl"](spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text
    assert f"GreaterThanOrEqual(p_partkey,{SPLIT})" in text


def test_entry(spark):
    assert entry.entry(spark).count() == 800

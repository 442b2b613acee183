"""Examples whose results are documented."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions import (
    accuracy_reward,
    apply_rewards,
    compute_reward,
    extract_answer,
    format_reward,
    math_equal,
    truth_column,
)

EQUIVALENT = [
    ("12", "12", True),
    (r"\frac{12}{5}", r"\frac{12}{5}", True),
    (r"\frac{24}{10}", r"\frac{12}{5}", True),
    (r"\sqrt{2}", r"$\sqrt{2}$", True),
    ("5", "6", False),
    ("", "", True),
    ("", "5", False),
]

RESPONSES = [
    ("<answer>12</answer>", "12", True),
    (r"<answer>\frac{12}{5}</answer>", r"\frac{12}{5}", True),
    (r"<answer>\frac{24}{10}</answer>", r"\frac{12}{5}", True),
    (r"<answer>\sqrt{2}</answer>", r"$\sqrt{2}$", True),
    ("<answer>5</answer>", "6", False),
    ("No answer tag here", "5", False),
]


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_extract(spark):
    df = spark.createDataFrame([("<answer>42</answer>",), ("none",), ("<answer></answer>",), (None,)], "c string")
    assert values(df, extract_answer(F.col("c"))) == ["42", None, "", None]


def test_equivalence(spark):
    df = spark.createDataFrame(EQUIVALENT, "a string, b string, expected boolean").coalesce(1)
    rows = df.select("a", "b", "expected", math_equal(F.col("a"), F.col("b")).alias("got")).collect()
    assert [row for row in rows if row.got != row.expected] == []


def test_responses(spark):
    df = spark.createDataFrame(RESPONSES, "response string, truth string, expected boolean").coalesce(1)
    rows = df.select(
        "expected",
        accuracy_reward(F.col("response"), F.col("truth")).alias("reward"),
        compute_reward(F.col("response"), F.col("truth")).alias("total"),
        F.col("response").contains("<answer>").alias("answered"),
    ).collect()
    assert [row.reward for row in rows] == [float(row.expected) for row in rows]
    assert [row.total for row in rows] == [0.1 * row.answered + 1.0 * row.expected for row in rows]


def test_batch(spark):
    rows = [
        ("Q1", "½ Reasoning... ½ <answer>12</answer>", "12"),
        ("Q2", r"<answer>\frac{12}{5}</answer>", r"\frac{24}{10}"),
        ("Q3", "No answer here", "5"),
        ("Q4", "<answer>5</answer>", "6"),
    ]
    df = spark.createDataFrame(rows, "prompt string, completion string, answer string").coalesce(1)
    assert values(apply_rewards(df), "accuracy_reward") == [1.0, 1.0, 0.0, 0.0]


def test_truth_goes_by_two_names(spark):
    df = spark.createDataFrame([("q", "<answer>5</answer>", "5")], "prompt string, completion string, ground_truth string")
    assert values(apply_rewards(df), "accuracy_reward") == [1.0]
    both = df.withColumn("answer", F.lit("6"))
    assert values(apply_rewards(both), "accuracy_reward") == [0.0]
    with pytest.raises(ValueError):
        truth_column(df.drop("ground_truth"))


def test_format(spark):
    rows = [("½ reasoning ½\n<answer>5</answer>",), ("½",), ("<ANSWER> </answer>",), ("x",), (None,)]
    df = spark.createDataFrame(rows, "c string").coalesce(1)
    assert values(df, format_reward(F.col("c"))) == [0.1, 0.05, 0.05, 0.0, 0.0]


def test_nulls(spark):
    rows = [(None, "5"), ("<answer>5</answer>", None), ("no block", None), ("<answer></answer>", "")]
    df = spark.createDataFrame(rows, "c string, t string").coalesce(1)
    assert values(df, accuracy_reward(F.col("c"), F.col("t"))) == [0.0, None, 0.0, 1.0]
    assert values(df, compute_reward(F.col("c"), F.col("t"))) == [0.0, None, 0.0, 1.1]

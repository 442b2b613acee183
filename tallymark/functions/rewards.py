"""Rewards of completions, as columns and as a registry of weighted rewards.

Three scores speak of "format" and stay apart: the bonus in :func:`compute_reward` (answer block
only), :func:`format_reward` (marker and answer block), and the weight of the latter in the total.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import (
    ACCURACY_WEIGHT,
    ANSWER_BLOCK_REWARD,
    CORRECT_ANSWER_BONUS,
    FORMAT_BONUS,
    FORMAT_WEIGHT,
    MARKER_REWARD,
    REASONING_MARKER,
)
from tallymark.functions.closed_form import applied, case
from tallymark.functions.equivalence import answer_key, equals_key, math_equal_sql
from tallymark.functions.text import completion_text, extract_answer, has_answer


def _score(points: float, condition: Column) -> Column:
    return F.when(condition, F.lit(float(points))).otherwise(F.lit(0.0))


def truth_column(df: DataFrame, answer: str | None = "answer", ground_truth: str | None = "ground_truth") -> Column:
    """The column that holds the truth: ``answer`` where the table has it, else ``ground_truth``."""
    for name in (answer, ground_truth):
        if name and name in df.columns:
            return F.col(name)
    raise ValueError("a table to be scored needs an `answer` or a `ground_truth` column")


def has_marker(completion: Column, marker: str = REASONING_MARKER) -> Column:
    return F.coalesce(F.contains(completion, F.lit(marker)), F.lit(False))


def answer_reward(extracted: Column, key: Column) -> Column:
    """1.0 for an extracted answer equal to the one behind ``key``, else 0.0.

    NULL where an answer meets no ground truth; such rows are rejects.
    """
    return (
        F.when(extracted.isNull(), F.lit(0.0))
        .when(key["text"].isNull(), F.lit(None).cast("double"))
        .otherwise(_score(1.0, equals_key(extracted, key)))
    )


def accuracy_sql(extracted: str, truth: str) -> str:
    """:func:`accuracy_reward` of an extracted answer, as SQL; the extraction is bound outside, once."""
    equal = (math_equal_sql(extracted, truth), "1D")
    return case((f"{extracted} IS NULL", "0D"), (f"{truth} IS NULL", "CAST(NULL AS DOUBLE)"), equal, otherwise="0D")


def compute_sql(extracted: str, truth: str, format_bonus: float = FORMAT_BONUS, correct_answer_bonus: float = CORRECT_ANSWER_BONUS) -> str:
    """:func:`compute_reward` of an extracted answer, as SQL."""
    bonus = case((math_equal_sql(extracted, truth), f"double('{float(correct_answer_bonus)!r}')"), otherwise="0D")
    return case((f"{extracted} IS NULL", "0D"), (f"{truth} IS NOT NULL", f"double('{float(format_bonus)!r}') + {bonus}"))


def accuracy_reward(completion: Column, truth: Column) -> Column:
    """1.0 where the first answer block of the completion holds the truth, else 0.0."""
    both = F.struct(extract_answer(completion).alias("answer"), truth.alias("truth"))
    return applied("a", accuracy_sql("a.answer", "a.truth"), both)


def format_reward(completion: Column, marker: str = REASONING_MARKER) -> Column:
    """Half for the reasoning marker, half for an answer block."""
    return _score(MARKER_REWARD, has_marker(completion, marker)) + _score(
        ANSWER_BLOCK_REWARD, has_answer(completion)
    )


def compute_reward(
    response: Column,
    truth: Column,
    format_bonus: float = FORMAT_BONUS,
    correct_answer_bonus: float = CORRECT_ANSWER_BONUS,
) -> Column:
    """Bonus for an answer block plus bonus for the right answer in it."""
    both = F.struct(extract_answer(response).alias("answer"), truth.alias("truth"))
    return applied("a", compute_sql("a.answer", "a.truth", format_bonus, correct_answer_bonus), both)


@dataclass(frozen=True)
class Reward:
    """A named, weighted reward.

    ``score(completion, truth)`` gives a column. ``of_completion`` and ``of_truth`` say what the
    score needs of each side: they are evaluated before completions meet truths, so that only
    the small results are shuffled, and ``score`` gets those results. By default it gets the
    columns themselves. A pandas UDF is as good as a built-in expression.
    """

    name: str
    weight: float
    score: Callable[[Column, Column], Column]
    of_completion: Callable[[Column], Column] | None = None
    of_truth: Callable[[Column], Column] | None = None

    def _left(self) -> str:
        return f"{self.name}__completion"

    def _right(self) -> str:
        return f"{self.name}__truth"


ACCURACY = Reward("accuracy_reward", ACCURACY_WEIGHT, answer_reward, extract_answer, answer_key)
FORMAT = Reward("format_reward", FORMAT_WEIGHT, lambda kept, truth: kept, format_reward, lambda truth: F.lit(None).cast("int"))
DEFAULT_REWARDS = (ACCURACY, FORMAT)


def check_rewards(rewards: Sequence[Reward]) -> Sequence[Reward]:
    names = [reward.name for reward in rewards]
    if not names or len(set(names)) != len(names):
        raise ValueError("rewards need different names, and at least one of them")
    return rewards


def completion_parts(rewards: Sequence[Reward], completion: Column) -> list[Column]:
    """What the rewards need of a completion."""
    return [
        (reward.of_completion(completion) if reward.of_completion else completion).alias(reward._left())
        for reward in check_rewards(rewards)
    ]


def truth_parts(rewards: Sequence[Reward], truth: Column) -> list[Column]:
    """What the rewards need of a ground truth."""
    return [(reward.of_truth(truth) if reward.of_truth else truth).alias(reward._right()) for reward in rewards]


def total_reward(df: DataFrame, rewards: Sequence[Reward], name: str = "total_reward") -> DataFrame:
    """Add the weighted sum of reward columns that are already there."""
    total = None
    for reward in rewards:
        weighted = F.lit(float(reward.weight)) * F.col(reward.name)
        total = weighted if total is None else total + weighted
    return df.withColumn(name, total)


def score_parts(df: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS) -> DataFrame:
    """Turn the parts of both sides into one column per reward and the weighted total."""
    scores = {reward.name: reward.score(F.col(reward._left()), F.col(reward._right())) for reward in rewards}
    parts = [part for reward in rewards for part in (reward._left(), reward._right())]
    return total_reward(df.withColumns(scores).drop(*parts), rewards)


def apply_rewards(
    df: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    completion: str = "completion",
    truth: str | None = None,
) -> DataFrame:
    """Score a table that holds completions (of any payload type) together with their truths."""
    truth_side = F.col(truth) if truth else truth_column(df)
    parts = df.select("*", *completion_parts(rewards, completion_text(df, completion)), *truth_parts(rewards, truth_side))
    return score_parts(parts, rewards)

"""From completions to rewards and group-relative advantages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import ADVANTAGE_EPS
from tallymark.functions.rewards import DEFAULT_REWARDS, Reward, completion_parts, score_parts, truth_column, truth_parts
from tallymark.functions.text import completion_text
from tallymark.operators.advantage import group_advantage
from tallymark.operators.joins import join_truth, match_truth
from tallymark.operators.skew import hot_keys
from tallymark.storage import materialize


def reduced_truths(problems: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS, key: str = "id") -> DataFrame:
    """What the rewards need of each problem's ground truth."""
    return problems.select(key, *truth_parts(rewards, truth_column(problems)))


def reduced_completions(
    completions: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS, key: str = "id"
) -> DataFrame:
    """What the rewards need of each completion, which may be text, messages, typed chunks or VARIANT."""
    return completions.select(key, "gen", *completion_parts(rewards, completion_text(completions)))


def score_reduced(
    reduced: DataFrame,
    truths: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    key: str = "id",
    hot: DataFrame | None = None,
    known_unique: bool = False,
) -> DataFrame:
    """Rewards per completion from what :func:`reduced_completions` and :func:`reduced_truths` gave."""
    return score_parts(join_truth(reduced, truths, key, hot, known_unique), rewards)


def score_rollouts(
    completions: DataFrame,
    problems: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    key: str = "id",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rewards per completion: ``key, gen``, one column per reward, ``total_reward``.

    Each side is first reduced to what the rewards need of it, so that the join moves extracted
    answers and not whole completions, and each truth is parsed once rather than per completion.
    """
    reduced = reduced_completions(completions, rewards, key)
    return score_reduced(reduced, reduced_truths(problems, rewards, key), rewards, key, hot)


def ungraded(scored: DataFrame) -> DataFrame:
    """Scored rows without a total: an answer met no ground truth, or an own reward gave none."""
    return scored.filter(F.col("total_reward").isNull())


@dataclass(frozen=True)
class Grades:
    """Rewards and advantages, and the completions that belong to no problem."""

    graded: DataFrame
    rejects: DataFrame


def grade_all(
    completions: DataFrame,
    problems: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    key: str = "id",
    eps: float = ADVANTAGE_EPS,
) -> Grades:
    """Rewards and advantage of every completion, and as rejects ``key, gen, reason`` the unmatched ones.

    Completions are read once: what the rewards need of them is written, and hot keys, join and
    statistics start from that. The scored rows, a few numbers each, are used twice and written.
    """
    reduced = materialize(reduced_completions(completions, rewards, key))
    hot = materialize(hot_keys(reduced, key))
    matched, unmatched = match_truth(reduced, reduced_truths(problems, rewards, key), key, hot)
    scored = materialize(score_parts(matched, rewards))
    graded = group_advantage(scored, group=key, eps=eps, hot=hot)
    return Grades(graded, unmatched.select(key, "gen", F.lit("no_problem").alias("reason")))


def grade_rollouts(
    completions: DataFrame,
    problems: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    key: str = "id",
    eps: float = ADVANTAGE_EPS,
) -> DataFrame:
    """Rewards and advantage of every completion that belongs to a problem (see :func:`grade_all`)."""
    return grade_all(completions, problems, rewards, key, eps).graded

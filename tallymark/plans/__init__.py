"""Compositions of operators."""

from tallymark.plans.evaluate import Evaluation, RunEvaluations, evaluate, evaluate_by_run, graded_predictions
from tallymark.plans.grade import (
    Grades,
    grade_all,
    grade_rollouts,
    reduced_completions,
    reduced_truths,
    score_reduced,
    score_rollouts,
    ungraded,
)
from tallymark.plans.prepare import Prepared, accepted, classify, prepare_all, prepare_rl, prepare_sft
from tallymark.plans.rounds import score_round, store_truths

__all__ = [
    "Evaluation",
    "Grades",
    "Prepared",
    "RunEvaluations",
    "accepted",
    "classify",
    "evaluate",
    "evaluate_by_run",
    "grade_all",
    "grade_rollouts",
    "graded_predictions",
    "prepare_all",
    "prepare_rl",
    "prepare_sft",
    "reduced_completions",
    "reduced_truths",
    "score_reduced",
    "score_rollouts",
    "score_round",
    "store_truths",
    "ungraded",
]

"""Prepare, verify and evaluate math-reasoning data as Spark jobs."""

from tallymark.functions import (
    accuracy_reward,
    compute_reward,
    extract_answer,
    format_reward,
    math_equal,
    normalize_latex,
    register_sql_functions,
)
from tallymark.plans import evaluate, grade_rollouts, prepare_all, prepare_rl, prepare_sft

__all__ = [
    "accuracy_reward",
    "compute_reward",
    "evaluate",
    "extract_answer",
    "format_reward",
    "grade_rollouts",
    "math_equal",
    "normalize_latex",
    "prepare_all",
    "prepare_rl",
    "prepare_sft",
    "register_sql_functions",
]

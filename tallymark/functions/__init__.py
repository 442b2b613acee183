"""Column functions, all built from Spark's own expressions."""

from tallymark.functions.closed_form import closed_form, closed_value
from tallymark.functions.equivalence import answer_key, equals_key, math_equal, same_closed_form
from tallymark.functions.exact import exact_form
from tallymark.functions.latex import clean_ground_truth, latex_to_expr, normalize_latex
from tallymark.functions.rewards import (
    ACCURACY,
    DEFAULT_REWARDS,
    FORMAT,
    Reward,
    accuracy_reward,
    apply_rewards,
    compute_reward,
    format_reward,
    has_marker,
    total_reward,
    truth_column,
)
from tallymark.functions.sql import register_sql_functions, register_sql_table_functions
from tallymark.functions.text import (
    completion_text,
    exact_equal,
    extract_answer,
    has_answer,
    report_name,
    run_name,
    strip,
    strip_image_tag,
    strip_prompt_prefix,
    text_chunks,
    text_messages,
    text_plain,
    text_variant,
)

__all__ = [
    "ACCURACY",
    "DEFAULT_REWARDS",
    "FORMAT",
    "Reward",
    "accuracy_reward",
    "answer_key",
    "apply_rewards",
    "clean_ground_truth",
    "closed_form",
    "closed_value",
    "completion_text",
    "compute_reward",
    "equals_key",
    "exact_form",
    "exact_equal",
    "extract_answer",
    "format_reward",
    "has_answer",
    "has_marker",
    "latex_to_expr",
    "math_equal",
    "normalize_latex",
    "register_sql_functions",
    "register_sql_table_functions",
    "report_name",
    "run_name",
    "same_closed_form",
    "strip",
    "strip_image_tag",
    "strip_prompt_prefix",
    "text_chunks",
    "text_messages",
    "text_plain",
    "text_variant",
    "total_reward",
    "truth_column",
]

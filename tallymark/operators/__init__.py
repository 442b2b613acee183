"""Operators on tables."""

from tallymark.operators.advantage import group_advantage, group_statistics
from tallymark.operators.chat import chat_rl, chat_rows, chat_sft, chat_user
from tallymark.operators.distinct import math_equal_distinct
from tallymark.operators.index import first_rows, running_total, stable_index
from tallymark.operators.joins import (
    join_predictions,
    join_teacher,
    join_truth,
    rollout_requests,
    with_image,
    without_image,
)
from tallymark.operators.metrics import (
    eval_report,
    eval_row,
    format_rate,
    gradable,
    grade,
    num_samples,
    predicted_answers,
    prep_summary,
    rate,
)
from tallymark.operators.pictures import image_intact
from tallymark.operators.samples import (
    completion_fallback,
    completion_source,
    field_defaults,
    first_image,
    has_image,
    image_kind,
    image_path,
    mock_completion,
    reject_reason,
    require_image,
    rl_sample,
    sample_id,
    sample_number,
    sft_sample,
    split_of,
    split_rl,
    split_sft,
    teacher_request,
    teacher_request_json,
)
from tallymark.operators.skew import exists_join, hot_keys, join_unique, one_per_key

__all__ = [
    "chat_rl",
    "chat_rows",
    "chat_sft",
    "chat_user",
    "completion_fallback",
    "completion_source",
    "eval_report",
    "eval_row",
    "exists_join",
    "field_defaults",
    "first_image",
    "first_rows",
    "format_rate",
    "gradable",
    "grade",
    "group_advantage",
    "group_statistics",
    "has_image",
    "hot_keys",
    "image_intact",
    "image_kind",
    "image_path",
    "join_predictions",
    "join_teacher",
    "join_truth",
    "join_unique",
    "math_equal_distinct",
    "mock_completion",
    "num_samples",
    "one_per_key",
    "predicted_answers",
    "prep_summary",
    "rate",
    "reject_reason",
    "require_image",
    "rl_sample",
    "rollout_requests",
    "running_total",
    "sample_id",
    "sample_number",
    "sft_sample",
    "split_of",
    "split_rl",
    "split_sft",
    "stable_index",
    "teacher_request",
    "teacher_request_json",
    "with_image",
    "without_image",
]

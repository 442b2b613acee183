"""The scalar functions under SQL names, as temporary SQL functions (no Python at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallymark.fixed import (
    ACCURACY_WEIGHT,
    ANSWER_BLOCK,
    ANSWER_BLOCK_REWARD,
    FORMAT_WEIGHT,
    IMAGE_TAG,
    MARKER_REWARD,
    REASONING_MARKER,
    WHITESPACE,
    WHITESPACE_CLASS,
)
from tallymark.functions.closed_form import let_sql
from tallymark.functions.equivalence import math_equal_sql
from tallymark.functions.latex import normalize_sql
from tallymark.functions.rewards import accuracy_sql, compute_sql


def _strip(sql: str) -> str:
    return f"btrim({sql}, r'{WHITESPACE}')"


_BARE = _strip("btrim(s, '$')")
_HAS_ANSWER = f"coalesce(s rlike r'{ANSWER_BLOCK}', false)"
_EXTRACTED = _strip(f"get(regexp_extract_all(s, r'{ANSWER_BLOCK}', 1), 0)")
_UNTAGGED = _strip(f"regexp_replace(s, r'(?iu){IMAGE_TAG}{WHITESPACE_CLASS}*', '')")

SQL_FUNCTIONS = {
    "extract_answer": ("s STRING", "STRING", _EXTRACTED),
    "normalize_latex": ("s STRING", "STRING", normalize_sql("s")),
    "format_reward": (
        "s STRING",
        "DOUBLE",
        f"if(coalesce(contains(s, '{REASONING_MARKER}'), false), {MARKER_REWARD}D, 0D)"
        f" + if({_HAS_ANSWER}, {ANSWER_BLOCK_REWARD}D, 0D)",
    ),
    "has_answer": ("s STRING", "BOOLEAN", _HAS_ANSWER),
    "clean_ground_truth": ("s STRING", "STRING", f"coalesce({_BARE}, '')"),
    "strip_image_tag": ("s STRING", "STRING", f"if({_UNTAGGED} <> '', {_UNTAGGED}, {_strip('s')})"),
    "math_equal": ("l STRING, r STRING", "BOOLEAN", math_equal_sql("l", "r")),
    "accuracy_reward": ("s STRING, truth STRING", "DOUBLE", let_sql("found", _EXTRACTED, accuracy_sql("found", "truth"))),
    "compute_reward": ("s STRING, truth STRING", "DOUBLE", let_sql("found", _EXTRACTED, compute_sql("found", "truth"))),
    "run_name": ("s STRING", "STRING", "substring_index(rtrim('/', s), '/', -1)"),
}


_FORMAT = SQL_FUNCTIONS["format_reward"][2]

# Functions that give rows: ``FROM completions c, LATERAL graded_completion(c.completion, c.ground_truth)``.
SQL_TABLE_FUNCTIONS = {
    "graded_completion": (
        "s STRING, truth STRING",
        "predicted_answer STRING, has_answer BOOLEAN, is_exact BOOLEAN, is_equivalent BOOLEAN, accuracy_reward DOUBLE, "
        "format_reward DOUBLE, total_reward DOUBLE",
        f"SELECT found, found IS NOT NULL, coalesce({_strip('found')} = {_strip('wanted')}, false), accuracy > 0D, accuracy, form, "
        f"{ACCURACY_WEIGHT}D * accuracy + {FORMAT_WEIGHT}D * form "
        f"FROM (SELECT found, wanted, form, {accuracy_sql('found', 'wanted')} AS accuracy "
        f"FROM (SELECT {_EXTRACTED} AS found, truth AS wanted, {_FORMAT} AS form))",
    ),
}


def register_sql_table_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the table functions in the session and return their names."""
    for name, (arguments, columns, body) in SQL_TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS TABLE({columns}) RETURN {body}")
    return [prefix + name for name in SQL_TABLE_FUNCTIONS]


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions in the session and return their names."""
    names = []
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {result} RETURN {body}")
        names.append(prefix + name)
    return names

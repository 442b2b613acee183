"""Whether two answers are the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.fixed import TOLERANCE
from tallymark.functions.closed_form import applied, case, closed_form, let_sql, value_sql
from tallymark.functions.latex import normalize_sql
from tallymark.functions.variables import agree_sql, is_algebra_sql, residues_sql


def key_sql(answer: str) -> str:
    """:func:`answer_key` as SQL."""
    parts = f"named_struct('text', s, 'value', {value_sql('s')}, 'residues', {residues_sql('s')})"
    return let_sql("s", normalize_sql(answer), parts)


def _close(left: str, right: str) -> str:
    return f"coalesce(abs({left} - {right}) < {TOLERANCE}D * greatest(abs({left}), abs({right}), 1D), false)"


def _texts(left: str, right: str) -> list[tuple[str, str]]:
    """What the texts alone decide."""
    return [
        (f"{left} = {right}", "true"),
        (f"{left} IS NULL OR {right} IS NULL", "CAST(NULL AS BOOLEAN)"),
        (f"lower({left}) = lower({right})", "true"),
    ]


def equals_key_sql(answer: str, key: str) -> str:
    """:func:`equals_key` as SQL."""
    by_value = let_sql("v", value_sql("s"), _close("v", f"{key}.value"))
    by_points = let_sql("z", residues_sql("s"), f"coalesce({agree_sql('z', f'{key}.residues')}, false)")
    tests = [(f"{key}.value IS NOT NULL", by_value), (f"{key}.residues IS NOT NULL", by_points)]
    return let_sql("s", normalize_sql(answer), case(*_texts("s", f"{key}.text"), *tests, otherwise="false"))


def math_equal_sql(left: str, right: str) -> str:
    """:func:`math_equal` as SQL."""
    # Both sides in one expression, since each is long.
    by_value = let_sql("v", f"transform(array(s.l, s.r), w -> {value_sql('w')})", _close("v[0]", "v[1]"))
    points = f"transform(array(s.l, s.r), w -> {residues_sql('w')})"
    by_points = let_sql("v", points, f"coalesce({agree_sql('v[0]', 'v[1]')}, false)")
    both = f"{is_algebra_sql('s.l')} AND {is_algebra_sql('s.r')}"
    tests = case(*_texts("s.l", "s.r"), (both, by_points), otherwise=by_value)
    return let_sql("s", f"named_struct('l', {normalize_sql(left)}, 'r', {normalize_sql(right)})", tests)


def answer_key(answer: Column) -> Column:
    """What grading needs of one answer: normalised text and its value in closed form or its residues with variables.

    Compute it once per ground truth, before the join with the many completions.
    """
    return applied("a", key_sql("a"), answer)


def equals_key(answer: Column, key: Column) -> Column:
    """Whether ``answer`` is the answer behind ``key`` (see :func:`answer_key`).

    Cheapest test first; the value of ``answer`` is computed only where the texts differ and the
    other side has a value.

    1. Normalised texts are identical, or but for case.
    2. Both are in closed form: the values agree within the relative tolerance. This includes
       all equal exact forms, since equal forms have the same value up to rounding.
    3. Both have variables: they are identical as expressions.
    """
    both = F.struct(answer.alias("answer"), key.alias("key"))
    return applied("a", equals_key_sql("a.answer", "a.key"), both)


def math_equal(left: Column, right: Column) -> Column:
    """Whether two answers are equivalent; NULL where either is NULL."""
    both = F.struct(left.alias("answer"), right.alias("truth"))
    return applied("a", math_equal_sql("a.answer", "a.truth"), both)


def same_closed_form(left: Column, right: Column) -> Column:
    """Whether both answers have the same exact key (a struct of NULLs is no key)."""
    a, b = closed_form(left), closed_form(right)
    return a.isNotNull() & b.isNotNull() & F.coalesce(a == b, F.lit(False))

"""LaTeX columns: normalised text and calculator-style text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.fixed import EXPR_SPELLING, INNER_FRACTION, INNER_ROOT, WHITESPACE, WHITESPACE_CLASS
from tallymark.functions.text import strip


def clean_ground_truth(answer: Column) -> Column:
    """Answer without dollars and then whitespace at its ends; ``''`` for no answer."""
    return F.coalesce(strip(F.btrim(answer, F.lit("$"))), F.lit(""))


def normalize_latex(text: Column) -> Column:
    r"""Text used to compare answers.

    Order matters and a second pass can change the text again: ``" $x$ "`` keeps its dollars,
    and each pass turns ``\\\\`` into ``\\``.
    """
    bare = strip(F.btrim(text, F.lit("$")))
    plain = F.replace(bare, F.lit("\\displaystyle"), F.lit(""))
    spaced = F.btrim(F.regexp_replace(plain, f"{WHITESPACE_CLASS}+", " "))
    return F.replace(spaced, F.lit("\\\\"), F.lit("\\"))


def normalize_sql(text: str) -> str:
    """:func:`normalize_latex` as SQL."""
    bare = f"btrim(btrim({text}, '$'), r'{WHITESPACE}')"
    spaced = rf"btrim(regexp_replace(replace({bare}, r'\displaystyle', ''), r'{WHITESPACE_CLASS}+', ' '))"
    return rf"replace({spaced}, r'\\', r'\')"


def latex_to_expr(text: Column) -> Column:
    r"""Fractions, roots, powers and products as calculator text: ``\frac{a}{b}`` to ``((a)/(b))``.

    Every pass rewrites all innermost fractions and roots at once, and the first one that changes
    nothing is the last that looks at the text. A pass that changes it uses up at least one
    ``\frac{`` or ``\sqrt{``, so as many passes as there are of those reach the end for any depth.
    """

    def one_pass(state: Column, _: Column) -> Column:
        fractions = F.regexp_replace(state["text"], INNER_FRACTION, r"(($1)/($2))")
        rewritten = F.transform(
            F.array(F.regexp_replace(fractions, INNER_ROOT, r"sqrt($1)")),
            lambda t: F.struct(t.alias("text"), (t == state["text"]).alias("done")),
        )
        return F.when(state["done"], state).otherwise(F.get(rewritten, F.lit(0)))

    passes = F.transform(
        F.array(normalize_latex(text)),
        lambda start: F.aggregate(
            F.regexp_extract_all(start, F.lit(r"\\(?:frac|sqrt)\{"), F.lit(0)),
            F.struct(start.alias("text"), F.lit(False).alias("done")),
            one_pass,
            lambda state: state["text"],
        ),
    )
    result = F.get(passes, F.lit(0))
    for old, new in EXPR_SPELLING.items():
        result = F.replace(result, F.lit(old), F.lit(new))
    return result

"""Queries for functions of constants, variables and exact sums: made from the columns of ``part``, grown with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import exact_form, math_equal
from tallymark.operators.skew import dealt
from tallymark.queries.registry import query

_N = "cast(p_size as string)"
_MORE = "cast(p_size + 1 as string)"
_TWICE = "cast(2 * p_size as string)"
_DIGIT = "cast(p_partkey % 9 + 1 as string)"
_NEXT = "cast(p_partkey % 9 + 2 as string)"

# Two spellings of the same value, and a third that differs, for each of eight kinds of part.
_FUNCTIONS = (
    (f"concat({_NEXT}, '!')", rf"concat({_NEXT}, '\\cdot ', {_DIGIT}, '!')", f"concat({_DIGIT}, '!')"),
    (f"concat('|-', {_N}, '|')", _N, f"concat('-', {_N})"),
    (rf"concat('\\sin(', {_N}, '\\pi)+1')", "'1'", rf"concat('\\cos(', {_TWICE}, '\\pi)+1')"),
    (rf"concat('\\ln ', {_N}, ' + \\ln 2')", rf"concat('\\ln\\left(', {_TWICE}, '\\right)')", rf"concat('\\ln ', {_N})"),
    (rf"concat('\\log_2 {{2^{{', {_DIGIT}, '}}}}')", _DIGIT, _NEXT),
    (rf"concat('\\binom{{', {_MORE}, '}}{{2}}')", rf"concat('\\frac{{', {_N}, '(', {_MORE}, ')}}{{2}}')", rf"concat('\\binom{{', {_MORE}, '}}{{3}}+0.5')"),
    (f"concat('2**', {_DIGIT})", f"concat('2^{{', {_DIGIT}, '}}')", f"concat('2*', {_DIGIT}, '+0.5')"),
    (rf"concat('\\sin^2 ', {_N}, '+\\cos^2 ', {_N})", "'1.'", rf"concat('\\sin ', {_N}, '+\\cos ', {_N})"),
)
_VARIABLES = (
    (f"concat({_N}, '(x+', {_MORE}, ')')", f"concat({_N}, 'x+', {_N}, '\\\\cdot ', {_MORE})", f"concat({_N}, 'x+', {_MORE}, '+0.5')"),
    (f"concat('(a+', {_N}, 'b)^2')", f"concat('a^2+', {_TWICE}, 'ab+', {_N}, '^2b^2')", f"concat('a^2+', {_N}, 'ab+', {_N}, '^2b^2')"),
    (
        rf"concat('\\frac{{x^2-', {_N}, '^2}}{{x-', {_N}, '}}')",
        f"concat('x+', {_N})",
        f"concat('x-', {_N})",
    ),
    (rf"concat('\\sqrt{{', {_N}, '\\cdot 4}}\\pi r')", rf"concat('2r\\pi\\sqrt{{', {_N}, '}}')", rf"concat('2r\\sqrt{{', {_N}, '}}')"),
    (rf"concat('\\frac{{1}}{{x_1}}+\\frac{{', {_N}, '}}{{x_2}}')", rf"concat('\\frac{{x_{{2}}+', {_N}, 'x_{{1}}}}{{x_1x_2}}')", rf"concat('\\frac{{x_2+', {_N}, '}}{{x_1x_2}}')"),
    (f"concat('t^{{-', {_DIGIT}, '}}')", rf"concat('\\frac{{1}}{{t^', {_DIGIT}, '}}')", f"concat('t^', {_DIGIT})"),
    (f"concat({_N}, '.5\\\\alpha')", rf"concat('\\frac{{', cast(2 * p_size + 1 as string), '\\alpha}}{{2}}')", f"concat({_N}, '.5\\\\beta')"),
    # Words are not products of their letters.
    ("concat('size ', p_type)", "upper(concat('size ', p_type))", "concat('zise ', p_type)"),
)


def _compared(spark: SparkSession, sf_dir: str, forms: tuple) -> DataFrame:
    """idx, and whether each first form equals the second, either way round, and the third."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_type")
    sides = "CASE p_partkey % 8 " + " ".join(
        f"WHEN {k} THEN array({', '.join(form)})" for k, form in enumerate(forms)
    ) + " END"
    pairs = dealt(part, *part.columns).select(F.col("p_partkey").alias("idx"), F.expr(sides).alias("s"))
    a, b, c = (F.get("s", F.lit(i)) for i in range(3))
    sides = [F.struct(F.lit(which).alias("which"), l.alias("l"), r.alias("r")) for which, l, r in (("same", a, b), ("swapped", b, a), ("near", a, c))]
    each = pairs.select("idx", F.explode(F.array(*sides)).alias("p"))
    return each.select("idx", "p.which", math_equal(F.col("p.l"), F.col("p.r")).alias("equal"))


_COMPARED_SQL = (
    "select p_partkey as idx, which, which <> 'near' as equal from part, (values ('same'), ('swapped'), ('near')) as w(which)"
)


@query("math_equal_functions", _COMPARED_SQL, on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, _FUNCTIONS)


@query("math_equal_variables", _COMPARED_SQL, on_fixtures=False)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, _VARIABLES)


# Spellings of p + 2 * sqrt(q), of which the first ones have the same key, for any p and q.
_SPELLINGS = (
    rf"concat({_N}, '+\\sqrt{{4\\cdot ', {_DIGIT}, '}}')",
    rf"concat('2\\sqrt{{', {_DIGIT}, '}}+', {_N})",
    rf"concat('\\frac{{', {_TWICE}, '+4\\sqrt{{', {_DIGIT}, '}}}}{{2}}')",
    rf"concat('\\frac{{', {_N}, '\\sqrt{{', {_DIGIT}, '}}+2\\cdot ', {_DIGIT}, '}}{{\\sqrt{{', {_DIGIT}, '}}}}')",
    rf"concat({_N}, '+\\sqrt{{4\\cdot ', {_DIGIT}, '}}+\\pi')",
)


@query(
    "exact_form",
    "select p_partkey as idx, unnest([4, 1]) as spellings, unnest([0, 1]) as pi_terms from part",
    on_fixtures=False,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of sums grouped by their exact keys: how many there are, and how many terms have a power of pi."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    texts = dealt(part, *part.columns).select(F.col("p_partkey").alias("idx"), F.explode(F.expr(f"array({', '.join(_SPELLINGS)})")).alias("text"))
    groups = texts.select("idx", exact_form(F.col("text"), spark).alias("key")).groupBy("idx", "key").agg(F.count(F.lit(1)).alias("n"))
    pi_terms = F.size(F.filter("key", lambda t: t["pi_power"] != 0))
    return groups.select("idx", F.col("n").cast("int").alias("spellings"), pi_terms.alias("pi_terms"))

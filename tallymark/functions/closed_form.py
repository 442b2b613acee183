r"""Values of closed-form answers, from built-in expressions only.

:func:`closed_value` gives the value of a text in the grammar of :mod:`tallymark.functions.grammar`; :func:`closed_form` gives
an exact key where no sum of several terms occurs. Both are NULL for any other text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.grammar import (
    ALPHABET,
    PLAIN_NUMBER,
    SHORT,
    SHORT_PARTS,
    Algebra,
    applied,
    case,
    evaluate_sql,
    let,
    let_sql,
    spelled,
)
from tallymark.functions.latex import normalize_sql

__all__ = ["applied", "case", "closed_form", "closed_value", "let", "let_sql", "value_sql"]

_BITS = 31  # the highest bit of an integer exponent; 38 digits are exceeded long before, but by 1 and pi
INTEGER = "decimal(38,0)"
# 170! is the largest factorial in a DOUBLE, and 33! the largest in 38 digits.
_FACTORIALS, _EXACT_FACTORIALS = 170, 33
# Factors of a binomial coefficient; more than these give no finite value but at the very ends.
_CHOSEN = 1_100


# --- values -------------------------------------------------------------------


def _double(text: Column) -> Column:
    return text.try_cast("double")


def up_to_sql(n: str, most: int) -> str:
    """1, 2, .. of at most ``most`` numbers; none for 0."""
    return f"slice(sequence(1, {most}), 1, try_cast({n} AS INT))"


def _double_factorial(n: str) -> str:
    whole = f"{n} >= 0 AND {n} <= {_FACTORIALS} AND {n} = floor({n})"
    return case((whole, f"aggregate({up_to_sql(n, _FACTORIALS)}, 1D, (f, i) -> f * i)"))


def _double_binomial(n: str, k: str) -> str:
    whole = f"{k} >= 0 AND {k} <= {n} AND {n} = floor({n}) AND {k} = floor({k}) AND least({k}, {n} - {k}) <= {_CHOSEN}"
    return case((whole, let_sql("j", f"least({k}, {n} - {k})", f"aggregate({up_to_sql('j', _CHOSEN)}, 1D, (f, i) -> f * ({n} - j + i) / i)")))


def _double_function(name: str, x: str) -> str:
    plain = [
        ("arcsin", f"asin({x})"),
        ("arccos", f"acos({x})"),
        ("arctan", f"atan({x})"),
        ("sinh", f"sinh({x})"),
        ("cosh", f"cosh({x})"),
        ("tanh", f"tanh({x})"),
        ("sin", f"sin({x})"),
        ("cos", f"cos({x})"),
        ("tan", f"tan({x})"),
        ("cot", f"try_divide(1D, tan({x}))"),
        ("sec", f"try_divide(1D, cos({x}))"),
        ("csc", f"try_divide(1D, sin({x}))"),
        ("exp", f"exp({x})"),
        ("ln", f"ln({x})"),
    ]
    based = case(("c = ''", f"log10({x})"), otherwise=f"try_divide(ln({x}), ln(try_cast(c AS DOUBLE)))")
    logarithm = let_sql("c", rf"regexp_extract({name}, r'_\{{([\d.]++)\}}', 1)", based)
    logarithms = rf"startswith({name}, r'\log') OR startswith({name}, r'\lg')"
    functions = [(rf"startswith({name}, r'\{each}')", value) for each, value in plain]
    return case((logarithms, logarithm), (f"contains({name}, '_')", "CAST(NULL AS DOUBLE)"), *functions)


_VALUES = Algebra(
    type="double",
    zero="0D",
    one="1D",
    pi="pi()",
    number=lambda t: f"try_cast({t} AS DOUBLE)",
    plus=lambda a, b: f"({a} + {b})",
    negative=lambda a: f"(-{a})",
    times=lambda a, b: f"({a} * {b})",
    over=lambda a, b: f"try_divide({a}, {b})",
    power=lambda a, b: f"pow({a}, {b})",
    root=lambda a: f"sqrt({a})",
    nth_root=lambda a, n: f"pow({a}, try_divide(1D, {n}))",
    absolute=lambda a: f"abs({a})",
    factorial=_double_factorial,
    binomial=_double_binomial,
    function=_double_function,
    simple=True,
)


def _short_value() -> str:
    """Value of the parts ``x`` of a short form."""
    sign, opened, number, radicand, pi, closed, divisor = (f"x[{i}]" for i in range(7))

    def or_one(text: str, value: str) -> str:
        return case((f"{text} = ''", "1D"), otherwise=value)

    def double(text: str) -> str:
        return f"try_cast({text} AS DOUBLE)"

    top = f"{or_one(number, double(number))} * {or_one(radicand, f'sqrt({double(radicand)})')} * {or_one(pi, 'pi()')}"
    signed = case((f"{sign} = '-'", f"-({top})"), otherwise=top)
    complete = f"({opened} = '') = ({closed} = '') AND concat({number}, {radicand}, {pi}) <> ''"
    return case((complete, f"try_divide({signed}, {or_one(divisor, double(divisor))})"))


def value_sql(normalized: str) -> str:
    """:func:`closed_value` of a text that was normalised already, as SQL."""
    parts = rf"split(regexp_replace(c, r'{SHORT}', r'{SHORT_PARTS}'), r'\|')"
    number = case(
        (f"c RLIKE r'{PLAIN_NUMBER}'", "try_cast(c AS DOUBLE)"),
        (f"c RLIKE r'{ALPHABET}'", let_sql("x", parts, case(("size(x) = 7 AND NOT contains(c, '|')", _short_value()), otherwise=evaluate_sql("c", _VALUES)))),
    )
    finite = let_sql("d", number, case(("abs(d) < double('Infinity')", "d")))
    return let_sql("c", spelled(normalized), finite)


def closed_value(text: Column) -> Column:
    """DOUBLE value of a closed-form text; NULL outside the grammar or where not finite."""
    return applied("s", value_sql(normalize_sql("s")), text)


# --- exact keys ---------------------------------------------------------------
#
# A key is ``sign * sqrt(num/den) * pi**pi_power``; a part beyond 38 digits is NULL.


def _key(sign: str, num: str, den: str, pi_power: str) -> str:
    parts = (("sign", sign, "INT"), ("num", num, INTEGER), ("den", den, INTEGER), ("pi_power", pi_power, "INT"))
    return "named_struct(" + ", ".join(f"'{name}', try_cast({value} AS {kind})" for name, value, kind in parts) + ")"


_UNKNOWN = _key("NULL", "NULL", "NULL", "NULL")


def _times(left: str, right: str) -> str:
    return f"try_cast(try_multiply({left}, {right}) AS {INTEGER})"


def _product_key(a: str, b: str) -> str:
    powers = f"try_add({a}.pi_power, {b}.pi_power)"
    return _key(f"{a}.sign * {b}.sign", _times(f"{a}.num", f"{b}.num"), _times(f"{a}.den", f"{b}.den"), powers)


def _number_key(t: str) -> str:
    digits = f"try_cast(replace({t}, '.', '') AS {INTEGER})"
    scale = rf"try_cast(concat('1', repeat('0', length(regexp_extract({t}, r'\.(\d++)$', 1)))) AS {INTEGER})"
    return let_sql("d", digits, let_sql("e", scale, _key("1", _times("d", "d"), _times("e", "e"), "0")))


def gcd_sql(a: str, b: str) -> str:
    step = f"CASE WHEN z.y = 0 THEN z ELSE named_struct('x', z.y, 'y', CAST(z.x % z.y AS {INTEGER})) END"
    # Euclid takes at most five divisions for every digit of the smaller number, and one more to get them in order.
    steps = f"sequence(1, 5 * length(CAST(least({a}, {b}) AS STRING)) + 1)"
    return f"aggregate({steps}, named_struct('x', {a}, 'y', {b}), (z, i) -> {step}, z -> z.x)"


def _reduced(k: str) -> str:
    """A key in lowest terms; NULL if any part of it is."""

    def divided(value: str) -> str:
        return f"CASE WHEN h = 1 THEN {value} ELSE try_cast(try_divide({value}, h) AS {INTEGER}) END"

    lowest = case(
        (f"{k}.num = 0", _key("0", "0", "1", "0")),
        otherwise=_key(f"{k}.sign", divided(f"{k}.num"), divided(f"{k}.den"), f"{k}.pi_power"),
    )
    known = f"{k}.num IS NOT NULL AND {k}.den > 0 AND {k}.pi_power IS NOT NULL AND {k}.sign IS NOT NULL"
    return case((known, let_sql("h", gcd_sql(f"{k}.num", f"{k}.den"), lowest)))


def whole_root_sql(square: str) -> str:
    """The integer whose square it is, else NULL; one step corrects the last digits of the estimate."""
    guess = f"try_cast(round(sqrt(CAST({square} AS DOUBLE))) AS {INTEGER})"
    step = f"try_cast(round(try_divide({square} - {_times('u', 'u')}, 2 * greatest(u, 1))) AS {INTEGER})"
    exact = case((f"{_times('w', 'w')} = {square}", "w"))
    return let_sql("u", guess, let_sql("w", f"try_cast(u + {step} AS {INTEGER})", exact))


def _rational(key: str, name: str, body: str) -> str:
    """``body`` with ``name`` as ``top, low`` of the key's value without its sign; NULLs where it isn't rational."""
    lowest = case((f"{key}.pi_power = 0", _reduced(key)))
    parts = f"named_struct('top', {whole_root_sql('m.num')}, 'low', {whole_root_sql('m.den')})"
    return let_sql(name, let_sql("m", lowest, parts), body)


def _power_key(base: str, exponent: str) -> str:
    """An integer power, by squaring; what isn't needed may overflow."""

    def step(field: str, square: str) -> str:
        return f"'{field}', CASE WHEN getbit(abs(CAST(x AS BIGINT)), i) = 1 THEN {_times(f'c.{field}', f'c.{square}')} ELSE c.{field} END"

    squares = f"'n', {_times('c.n', 'c.n')}, 'd', {_times('c.d', 'c.d')}"
    one = f"CAST(1 AS {INTEGER})"
    start = f"named_struct('num', {one}, 'den', {one}, 'n', {base}.num, 'd', {base}.den)"
    raised = (
        f"aggregate(sequence(0, {_BITS}), {start}, "
        f"(c, i) -> named_struct({step('num', 'n')}, {step('den', 'd')}, {squares}))"
    )
    key = _key(
        f"CASE WHEN x % 2 = 0 THEN abs({base}.sign) ELSE {base}.sign END",
        "CASE WHEN x < 0 THEN c.den ELSE c.num END",
        "CASE WHEN x < 0 THEN c.num ELSE c.den END",
        f"try_multiply(CAST({base}.pi_power AS BIGINT), CAST(x AS BIGINT))",
    )
    whole = _rational(exponent, "r", case(("r.low = 1", f"try_cast(r.top * {exponent}.sign AS INT)")))
    return let_sql("x", whole, let_sql("c", raised, key))


def _root_key(value: str) -> str:
    root = _key("CASE WHEN r.top = 0 THEN 0 ELSE 1 END", "r.top", "r.low", "0")
    return case((f"{value}.sign >= 0", _rational(value, "r", root)), otherwise=_UNKNOWN)


def _whole_number(key: str, name: str, body: str) -> str:
    """``body`` with ``name`` as the key's value if that is a whole number from 0, else an unknown key."""
    whole = case((f"r.low = 1 AND {key}.sign >= 0", "r.top"))
    return _rational(key, "r", let_sql(name, whole, case((f"{name} IS NOT NULL", body), otherwise=_UNKNOWN)))


def _whole_key(n: str) -> str:
    return let_sql("f", n, _key("CASE WHEN f = 0 THEN 0 ELSE 1 END", _times("f", "f"), "1", "0"))


def _key_factorial(n: str) -> str:
    product = f"aggregate({up_to_sql('w', _EXACT_FACTORIALS)}, CAST(1 AS {INTEGER}), (f, i) -> {_times('f', f'CAST(i AS {INTEGER})')})"
    return _whole_number(n, "w", case((f"w <= {_EXACT_FACTORIALS}", _whole_key(product)), otherwise=_UNKNOWN))


def _key_binomial(n: str, k: str) -> str:
    factor = f"CAST(w - j + i AS {INTEGER})"
    product = (
        f"aggregate({up_to_sql('j', _CHOSEN)}, CAST(1 AS {INTEGER}), "
        f"(f, i) -> try_cast(try_divide({_times('f', factor)}, i) AS {INTEGER}))"
    )
    known = case((f"z <= w AND least(z, w - z) <= {_CHOSEN}", let_sql("j", "least(z, w - z)", _whole_key(product))), otherwise=_UNKNOWN)
    return _whole_number(n, "w", _whole_number(k, "z", known))


_KEYS = Algebra(
    type=f"struct<sign:int,num:{INTEGER},den:{INTEGER},pi_power:int>",
    zero=_key("0", "0", "1", "0"),
    one=_key("1", "1", "1", "0"),
    pi=_key("1", "1", "1", "1"),
    number=_number_key,
    plus=lambda a, b: case((f"{a}.sign = 0", b), (f"{b}.num = 0", a), otherwise=_UNKNOWN),
    negative=lambda a: _key(f"-{a}.sign", f"{a}.num", f"{a}.den", f"{a}.pi_power"),
    times=_product_key,
    over=lambda a, b: let_sql(
        "y", _key(f"{b}.sign", f"{b}.den", f"CASE WHEN {b}.num <> 0 THEN {b}.num END", f"try_subtract(0, {b}.pi_power)"), _product_key(a, "y")
    ),
    power=_power_key,
    root=_root_key,
    nth_root=lambda a, n: case(
        (f"{n}.sign = 1 AND {n}.pi_power = 0 AND {n}.num = {_times('4', f'{n}.den')}", _root_key(a)), otherwise=_UNKNOWN
    ),
    absolute=lambda a: _key(f"abs({a}.sign)", f"{a}.num", f"{a}.den", f"{a}.pi_power"),
    factorial=_key_factorial,
    binomial=_key_binomial,
    function=lambda name, x: _UNKNOWN,
)


def closed_form(text: Column) -> Column:
    r"""Exact key ``sign * sqrt(num/den) * pi**pi_power`` of a text without a sum of several terms.

    Equal keys mean equal values. NULL for sums, for other texts, for roots of anything but a
    ratio, and beyond 38 digits.
    """

    lowest = let_sql("k", evaluate_sql("c", _KEYS), _reduced("k"))
    found = let_sql("c", spelled(normalize_sql("s")), case((f"c RLIKE r'{ALPHABET}'", lowest)))
    return applied("s", found, text)

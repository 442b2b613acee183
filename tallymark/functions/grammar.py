r"""The grammar of answers, evaluated from built-in expressions only, for any kind of value.

Sums, products, quotients and powers of numbers, ``\sqrt{..}``, ``\sqrt[n]{..}``, ``\pi``, ``\binom{..}{..}``, factorials and
functions (``\sin``, ``\ln``, ``\log_{b}`` and others), grouped by parentheses, braces, bars of an absolute value and
``\frac{..}{..}`` to any depth; where the caller allows it, also variables.

A text is cut into tokens once, and one pass over the tokens computes the result. The pass keeps a stack of open groups, of
which a token changes the innermost one only. The groups far around it are put away where nothing copies them with every
token, so that the cost grows with the number of tokens, whatever their nesting.

Everything is written as SQL text, in which a lambda of any size costs one call into the JVM and not thousands.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.latex import normalize_sql

_NUMBER = r"(?:\d++(?:\.\d*+)?+|\.\d++)(?![\d.])"
_TRIGONOMETRIC = "sin|cos|tan|cot|sec|csc"
_FUNCTIONS = rf"(?:arcsin|arccos|arctan|sinh|cosh|tanh|{_TRIGONOMETRIC}|ln|log|lg|exp)"
# A function is one token with its base, its power and the bracket of its argument.
_BASE, _POWER = r"(?:_\{[\d.]++\})?+", r"(?:\^\{\d++\})?+"
_FUNCTION = rf"\\{_FUNCTIONS}{_BASE}{_POWER}[({{]"
# So is a construct or a power with the brace after it.
_TOKEN = rf"{_NUMBER}|\\(?:frac|sqrt|binom)\{{?+|\\pi|{_FUNCTION}|\^[({{]?+|[+\-*/(){{}}\[\]|!]"
# A ratio or a root of numbers, which some algebras take as one token.
_SIMPLE = rf"\\frac\{{{_NUMBER}\}}\{{{_NUMBER}\}}|\\sqrt\{{{_NUMBER}\}}"
GREEK = (
    "alpha|beta|gamma|delta|varepsilon|epsilon|zeta|eta|vartheta|theta|iota|kappa|lambda|mu|nu|xi|rho|sigma|tau|upsilon|"
    "varphi|phi|chi|psi|omega|Gamma|Delta|Theta|Lambda|Xi|Sigma|Upsilon|Phi|Psi|Omega"
)
_VARIABLE = rf"(?:\\(?:{GREEK})(?![A-Za-z])|[A-Za-z])(?:_(?:[A-Za-z0-9]|\{{[A-Za-z0-9]++\}}))?+"

PLAIN_NUMBER = r"^[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)$"
ALPHABET = rf"^(?:\\frac|\\sqrt|\\pi(?![A-Za-z])|\\binom|{_FUNCTION}|[0-9.+\-*/^(){{}}\[\]|!])++$"

# The most frequent forms: a number, a square root and pi, each at most once, over a number at most.
# Groups: sign, start of a fraction, number, radicand, pi, middle of a fraction, divisor.
SHORT = (
    rf"^([+-]?+)(\\frac\{{)?+({_NUMBER})?+(?:\\sqrt\{{({_NUMBER})\}})?+(\\pi)?+(?:(\}}\{{)({_NUMBER})\}})?+$"
)
SHORT_PARTS = "$1|$2|$3|$4|$5|$6|$7"

# Groups around the innermost one that are at hand, and how many of them are put away together.
_NEAR, _PIECE = 12, 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def applied(name: str, sql: str, value: Column) -> Column:
    """SQL in which ``name`` stands for a column. The text of a lambda of any size is one call into the JVM."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {sql}")), F.lit(0))


def case(*branches: tuple[str, str], otherwise: str = "NULL") -> str:
    """The first branch that is found. Where it is not compiled, CASE counts its branches anew at each of them; IF doesn't."""
    for found, then in reversed(branches):
        otherwise = f"if({found}, {then}, {otherwise})"
    return otherwise


def let_sql(name: str, value: str, body: str) -> str:
    # A transformation copies what it returns, with all texts in it; the end of an aggregation over nothing does not.
    return f"aggregate(array(), {value}, (z, i) -> z, {name} -> {body})"


def _rewritten(text: str, *rules: tuple[str, str]) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, r'{pattern}', r'{replacement}')"
    return text


# An argument without brackets: simple factors and quotients of them.
_ARGUMENT_PART = rf"(?:{_NUMBER}|\\pi(?![A-Za-z])|\\frac\{{[^{{}}]*+\}}\{{[^{{}}]*+\}}|\\sqrt\{{[^{{}}]*+\}})(?:\^(?:\d|\{{[^{{}}]*+\}}))?+"
_ARGUMENT = rf"{_ARGUMENT_PART}(?:[*/]?+{_ARGUMENT_PART})*+"


def spelled(normalized: str) -> str:
    """One spelling per construct, without whitespace, of a text that was normalised once.

    Most answers need few of the rules; the two tests say which ones have none to apply.
    """
    bare = r"NOT (b RLIKE r'^\$|\$$' OR contains(b, r'\\') OR contains(b, r'\displaystyle'))"
    again = let_sql("b", normalized, case((bare, "b"), otherwise=normalize_sql("b")))
    words = _rewritten(
        "b",
        (r"\\(?:left|right)(?![A-Za-z])|\\[,;:!]", " "),
        (r"\\[dt](frac|binom)(?![A-Za-z])", r"\\$1"),
        (r"\\(?:cdot|times)(?![A-Za-z])", "*"),
        (r"\\div(?![A-Za-z])", "/"),
        (r"\*\*", "^"),
        # Bases and powers of functions get braces, and an inverse its own name.
        (r"\\(?:[lr]?+vert|mid)(?![A-Za-z])", "|"),
        (r"\\(sin|cos|tan) ?+\^ ?+(?:\{ ?+- ?+1 ?+\}|-1)", r"\\arc$1"),
        (rf"\\({_FUNCTIONS}) ?+_ ?+(\d)", r"\\$1_{$2}"),
        (rf"\\({_FUNCTIONS}{_BASE}) ?+\^ ?+(\d)", r"\\$1^{$2}"),
    )
    commands = r"b RLIKE r'\*\*|\\(?!frac(?![A-Za-z])|sqrt(?![A-Za-z])|pi(?![A-Za-z]))'"
    named = let_sql("b", again, case((commands, words), otherwise="b"))
    joined = _rewritten(
        "b",
        # Arguments without braces are single digits.
        (r"\\(frac|binom) ?+(\d) ?+(\d)", r"\\$1{$2}{$3}"),
        (r"\\(frac|binom) ?+(\d) ?+(?=\{)", r"\\$1{$2}"),
        (r"\\sqrt ?+(\d)", r"\\sqrt{$1}"),
        # Digits apart from each other are no number: the question mark is outside the grammar.
        (r"(?<=[\d.]) ++(?=[\d.])", "?"),
        (" ", ""),
        (r"(?<=\d),(?=\d{3}(?!\d))", ""),
        (rf"(\\{_FUNCTIONS}{_BASE}{_POWER})({_ARGUMENT})", "$1($2)"),
    )
    loose = rf"b RLIKE r'[ ,]|\\(?:frac|sqrt|binom)\d|\\{_FUNCTIONS}'"
    return let_sql("b", named, case((loose, joined), otherwise="b"))


@dataclass(frozen=True)
class Algebra:
    """What the pass computes with, as SQL of SQL operands. NULL is a result that there is none."""

    type: str
    zero: str
    one: str
    pi: str
    number: Callable[[str], str]
    plus: Callable[[str, str], str]
    negative: Callable[[str], str]
    times: Callable[[str, str], str]
    over: Callable[[str, str], str]
    power: Callable[[str, str], str]
    root: Callable[[str], str]
    nth_root: Callable[[str, str], str]
    absolute: Callable[[str], str]
    factorial: Callable[[str], str]
    binomial: Callable[[str, str], str]
    # Of the token of a function, as ``\log_{2}^{3}(``.
    function: Callable[[str, str], str]
    # Whether a function's value is still to be raised to the power in its token.
    raises: bool = True
    variable: Callable[[str], str] | None = None
    # Whether a number is the same after it was added to zero and multiplied with one, so that no group need be opened for it.
    simple: bool = False


# What a group is in the middle of, besides a plain sum.
_PLAIN, _RAISED, _DONE, _EXPONENT, _MINUS = "''", "'p'", "'!'", "'^'", "'-'"
_LOW, _CHOSEN, _ROOT, _RADICAND = "'d'", "'w'", "'s'", "'r'"
# What a group is after that may go on in any way; it contains the empty text of a plain sum too.
_SETTLED = "'p!'"
# The group around a whole text, which nothing but the text's value gets into.
_BASE_GROUP = "'base'"
_FIELDS = ("kind", "total", "product", "factor", "has", "minus", "divides", "amid", "held")


def _group(kind: str, algebra: Algebra) -> str:
    """A group that was just opened: total, product and factor so far, and how the next part goes on."""
    values = (kind, algebra.zero, algebra.one, algebra.one, "false", "false", "false", _PLAIN, algebra.one)
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in zip(_FIELDS, values)) + ")"


def _with(group: str, **changes: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {changes.get(n, f'{group}.{n}')}" for n in _FIELDS) + ")"


def _settled(g: str) -> str:
    return f"contains({_SETTLED}, {g}.amid)"


def _complete(g: str) -> str:
    return f"({_settled(g)} AND {g}.has)"


def _product(g: str, algebra: Algebra) -> str:
    product, factor = f"{g}.product", f"{g}.factor"
    return case((f"{g}.divides", algebra.over(product, factor)), otherwise=algebra.times(product, factor))


def _sum(g: str, algebra: Algebra) -> str:
    """The total with the product ``p``, which was just ended."""
    signed = case((f"{g}.minus", algebra.negative("p")), otherwise="p")
    return let_sql("q", signed, algebra.plus(f"{g}.total", "q"))


def _operand(g: str, value: str, algebra: Algebra) -> str:
    """The next factor; without an operator before it, it multiplies."""
    return _with(
        g,
        product=case((f"{g}.has", _product(g, algebra)), otherwise=f"{g}.product"),
        divides=f"({g}.divides AND NOT {g}.has)",
        factor=value,
        has="true",
        amid=_PLAIN,
    )


def _to_power(g: str, exponent: str, algebra: Algebra) -> str:
    return _with(g, factor=algebra.power(f"{g}.factor", exponent), amid=_RAISED)


def _ended(algebra: Algebra) -> str:
    """The complete group ``g`` with the product ``p`` after a sign or an operator ``t``."""
    fresh = {"factor": algebra.one, "has": "false", "amid": _PLAIN}
    summed = _with("g", total=_sum("g", algebra), product=algebra.one, minus="(t = '-')", divides="false", **fresh)
    linked = _with("g", product="p", divides="(t = '/')", **fresh)
    return case(("contains('+-', t)", summed), otherwise=linked)


def _inside(algebra: Algebra) -> str:
    """The group ``g`` after a power, a factorial, the start of a root with a degree, or a sign before a factor, ``t``.

    NULL if it can't stand there.
    """
    sign = case(
        (f"g.amid = {_EXPONENT} AND t = '-'", _with("g", amid=_MINUS)),
        (_settled("g"), _with("g", minus="(g.minus <> (t = '-'))")),
    )
    counted = _with("g", factor=algebra.factorial("g.factor"), amid=_DONE)
    return case(
        ("contains('+-', t)", sign),
        ("contains('*/', t)", "NULL"),
        ("t = '^'", case((f"g.has AND g.amid = {_PLAIN}", _with("g", amid=_EXPONENT)))),
        ("t = '!'", case((f"g.has AND (g.amid = {_PLAIN} OR g.amid = {_RAISED})", counted))),
        (r"t = r'\sqrt'", case((_settled("g"), _with("g", amid=_ROOT)))),
    )


def _is_number(t: str) -> str:
    return f"(({t} >= '0' AND {t} < ':') OR startswith({t}, '.'))"


def _atom(algebra: Algebra) -> str:
    """The value of a number, of pi or of a variable ``t``."""
    other = algebra.variable("t") if algebra.variable else algebra.pi
    return case((_is_number("t"), algebra.number("t")), (r"t = r'\pi'", algebra.pi), otherwise=other)


def _simple(algebra: Algebra) -> str:
    """The value of a ratio or a root of numbers ``t``."""
    inner = "substring(t, 7, length(t) - 7)"
    root = let_sql("x", algebra.number(inner), algebra.root("x"))
    top, low = (algebra.number(f"substring_index({inner}, '}}{{', {part})") for part in (1, -1))
    ratio = let_sql("x", top, let_sql("y", low, algebra.over("x", "y")))
    return case((r"startswith(t, r'\sqrt')", root), otherwise=ratio)


def _opened() -> str:
    """The kind of group that a bracket ``t`` opens in ``g``; NULL if it can't stand there. It ends with the bracket."""
    begun = case((r"t = r'\frac{'", "'n{'"), (r"t = r'\sqrt{'", "'r{'"), (r"t = r'\binom{'", "'m{'"), otherwise="t")
    return case(
        (f"g.kind = {_BASE_GROUP}", "CAST(NULL AS STRING)"),
        ("startswith(t, '^')", case((f"g.has AND g.amid = {_PLAIN}", "t"))),
        ("t = '['", case((f"g.amid = {_ROOT}", "'['"))),
        (_settled("g"), begun),
        (f"t = '{{' AND (g.amid = {_LOW} OR g.amid = {_CHOSEN} OR g.amid = {_RADICAND})", "concat(g.amid, t)"),
    )


def _called(algebra: Algebra) -> str:
    """A function of ``d.value``, raised to the power in its token."""
    power = r"regexp_extract(d.kind, r'\^\{(\d++)\}', 1)"
    if not algebra.raises:
        return algebra.function("d.kind", "d.value")
    raised = let_sql("e", algebra.number("x"), algebra.power("u", "e"))
    return let_sql("u", algebra.function("d.kind", "d.value"), let_sql("x", power, case(("x = ''", "u"), otherwise=raised)))


def _delivered(algebra: Algebra) -> str:
    """The group ``d.group`` after it got the value of an atom or, by ``d.kind``, of a group inside of it."""
    group = "d.group"
    value = case(
        ("contains('({', d.kind)", "d.value"),
        ("d.kind = 'd{'", algebra.over("d.group.held", "d.value")),
        (
            "d.kind = 'r{'",
            case((f"d.group.amid = {_RADICAND}", algebra.nth_root("d.value", "d.group.held")), otherwise=algebra.root("d.value")),
        ),
        ("d.kind = '|'", algebra.absolute("d.value")),
        ("d.kind = 'w{'", algebra.binomial("d.group.held", "d.value")),
        otherwise=_called(algebra),
    )
    next_ = case(("d.kind = 'n{'", _LOW), ("d.kind = 'm{'", _CHOSEN), otherwise=_RADICAND)
    exponent = case((f"d.group.amid = {_MINUS}", algebra.negative("d.value")), otherwise="d.value")
    return case(
        (
            f"startswith(d.kind, '^') OR d.group.amid = {_EXPONENT} OR d.group.amid = {_MINUS}",
            let_sql("w", exponent, _to_power(group, "w", algebra)),
        ),
        ("d.kind = 'n{' OR d.kind = 'm{' OR d.kind = '['", _with(group, held="d.value", amid=next_)),
        (f"d.kind <> '' OR {_settled(group)}", _operand(group, value, algebra)),
    )


def _state(top: str, near: str, far: str) -> str:
    return f"named_struct('top', {top}, 'near', {near}, 'far', {far})"


def _pass(algebra: Algebra) -> tuple[str, str, str]:
    """Start, step and end of the aggregation over tokens.

    The state is the innermost group, the nearest groups around it, and all others as lines of JSON, a line for ``_PIECE``
    groups. A state without an innermost group stays as it is. An aggregation copies its state with every token, but not what is binary in it: so the far groups, however many,
    cost nothing until a line is added or taken, which is once in several brackets.
    """
    kind = algebra.type
    values = {"kind": "string", "has": "boolean", "minus": "boolean", "divides": "boolean", "amid": "string"}
    schema = "array<struct<" + ",".join(f"{name}:{values.get(name, kind)}" for name in _FIELDS) + ">>"
    ends = case(("t = ')'", "'('"), ("t = '}'", "'{'"), ("t = ']'", "'['"), otherwise="'|'")
    line = "substring_index(CAST(a.far AS STRING), chr(10), -1)"
    less = "substring(a.far, 1, greatest(length(a.far) - octet_length(l) - 1, 0))"

    def delivery(group: str, value: str, inner: str, near: str, far: str) -> str:
        return f"named_struct('group', {group}, 'value', {value}, 'kind', {inner}, 'near', {near}, 'far', {far})"

    def popped(near: str, far: str) -> str:
        return delivery(f"element_at({near}, -1)", "v", "g.kind", f"slice({near}, 1, size({near}) - 1)", far)

    after = case(
        ("size(a.near) > 0", popped("a.near", "a.far")),
        ("length(a.far) > 0", let_sql("l", line, let_sql("b", f"from_json(l, '{schema}')", popped("b", less)))),
    )
    closing = case((f"endswith(g.kind, {ends}) AND {_complete('g')}", let_sql("p", _product("g", algebra), let_sql("v", _sum("g", algebra), after))))
    new = _group("k", algebra)
    written = f"concat(a.far, CAST(concat(CASE WHEN length(a.far) > 0 THEN chr(10) ELSE '' END, to_json(slice(a.near, 1, {_PIECE}))) AS BINARY))"
    pushed = case(
        (f"size(a.near) >= {_NEAR}", _state(new, f"array_append(slice(a.near, {_PIECE + 1}, {_NEAR}), g)", written)),
        otherwise=_state(new, "array_append(a.near, g)", "a.far"),
    )
    opening = let_sql("k", _opened(), case(("k IS NOT NULL", pushed)))
    ended = let_sql("p", _product("g", algebra), _state(_ended(algebra), "a.near", "a.far"))
    inside = _state(_inside(algebra), "a.near", "a.far")
    staying = case((f"contains('+-*/', t) AND {_complete('g')}", ended), otherwise=inside)
    closes = f"contains(')}}]', t) OR (t = '|' AND g.kind = '|' AND {_complete('g')})"
    opens = f"contains('([{{', t) OR (t = '|' AND NOT (g.kind = '|' AND {_complete('g')}))"
    command = r"(startswith(t, r'\') OR startswith(t, '^'))"
    atom = let_sql("v", _atom(algebra), delivery("g", "v", "''", "a.near", "a.far"))
    if algebra.simple:
        # It stands where a construct may begin, which is not in an exponent, and is a factor as a group is.
        found = let_sql("v", _simple(algebra), delivery("g", "v", "'('", "a.near", "a.far"))
        atom = case((r"startswith(t, r'\') AND endswith(t, '}')", case((_settled("g"), found))), otherwise=atom)
    brought = case((closes, closing), otherwise=atom)
    given = _state(_delivered(algebra), "d.near", "d.far")
    taken = let_sql("d", brought, case(("d IS NOT NULL", given)))
    moved = case(
        (r"contains('+-*/^!', t) OR t = r'\frac' OR t = r'\sqrt' OR t = r'\binom'", staying),
        (f"{opens} OR ({command} AND (endswith(t, '{{') OR endswith(t, '(')))", opening),
        otherwise=taken,
    )
    step = case(("a.top IS NULL", "NULL"), otherwise=let_sql("g", "a.top", moved))
    start = _state(_group("'('", algebra), f"array({_group(_BASE_GROUP, algebra)})", "CAST('' AS BINARY)")
    end = case((f"a.top.kind = {_BASE_GROUP} AND a.top.has", "a.top.factor"))
    return start, f"(a, t) -> {step}", f"a -> {end}"


def tokens_sql(text: str, variables: bool = False, simple: bool = False) -> str:
    """The tokens of a spelled text; NULL if something is left over or its brackets are not as many as they should be."""
    pattern = "|".join([_SIMPLE] * simple + [_TOKEN] + [_VARIABLE] * variables)
    # Texts that can't be balanced are told apart before a stack of their brackets is built.
    opened, closed = (rf"length(regexp_replace({text}, r'[^{kind}]++', ''))" for kind in (r"(\[{", r")\]}"))
    whole = let_sql("x", f"regexp_extract_all({text}, r'{pattern}', 0)", case((f"array_join(x, '') = {text}", "x")))
    return case((f"{opened} = {closed}", whole))


def fold_sql(tokens: str, algebra: Algebra) -> str:
    """The result of tokens, NULL outside the grammar."""
    start, step, end = _pass(algebra)
    return f"aggregate(array_append({tokens}, ')'), {start}, {step}, {end})"


def evaluate_sql(text: str, algebra: Algebra) -> str:
    """The result of a spelled text, NULL outside the grammar."""
    return let_sql("xs", tokens_sql(text, simple=algebra.simple), case(("xs IS NOT NULL", fold_sql("xs", algebra))))

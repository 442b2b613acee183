r"""Exact keys of answers that are sums: equal values have equal keys.

A value is a sum of terms ``num/den * sqrt(radicand) * pi**pi_power`` with a square-free radicand, at most one for every
radicand and power of pi, in their order; zero has none. Such a sum is unique for its value, so that answers can be grouped by
it: ``1+\sqrt{8}`` and ``2\sqrt{2}+1`` have the same key.

Products multiply all terms of both sides and add up what belongs together. A divisor of two terms is made one by its
conjugate. NULL where a value isn't such a sum or can't be told: roots of sums, functions, divisors of more terms or of two
terms with different powers of pi, whole numbers beyond 38 digits (and while a fraction is reduced, beyond 32), and radicands
of which more than ``10**9`` is left after division by the primes below 1,000, unless that is a square.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from tallymark.functions.closed_form import INTEGER, gcd_sql, up_to_sql, whole_root_sql
from tallymark.functions.grammar import ALPHABET, Algebra, applied, case, evaluate_sql, let_sql, spelled
from tallymark.functions.latex import normalize_sql

_TERM = f"struct<radicand:{INTEGER},pi_power:int,num:{INTEGER},den:{INTEGER}>"
_TYPE = f"array<{_TERM}>"
_NONE = f"CAST(NULL AS {_TYPE})"
# A prime's square divides a number of 38 digits at most so many times.
_MULTIPLES = 63
_BITS = 16
# Rounds in which Spark finds the types of a lambda within a lambda within another; by default it gives up after 100.
_ROUNDS = "spark.sql.analyzer.maxIterations", 300
_FACTORIALS = 33


def _primes(below: int) -> list[int]:
    return [n for n in range(2, below) if all(n % p for p in range(2, int(n**0.5) + 1))]


_SMALL = f"array({', '.join(f'{p}L' for p in _primes(1_000))})"


def _int(value: str) -> str:
    return f"try_cast({value} AS {INTEGER})"


def _times_int(a: str, b: str) -> str:
    return _int(f"try_multiply({a}, {b})")


def _term(radicand: str, pi_power: str, num: str, den: str) -> str:
    values = (_int(radicand), f"try_cast({pi_power} AS INT)", _int(num), _int(den))
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(("radicand", "pi_power", "num", "den"), values)) + ")"


def _terms(*terms: str) -> str:
    return f"CAST(array({', '.join(terms)}) AS {_TYPE})"


def _known(t: str) -> str:
    return f"({t}.radicand IS NOT NULL AND {t}.pi_power IS NOT NULL AND {t}.num IS NOT NULL AND {t}.den IS NOT NULL)"


def _merged(terms: str) -> str:
    """A list of terms with one for each radicand and power of pi, in lowest terms and in order; NULL if one is not known."""
    same = "(size(acc) > 0 AND acc[0].radicand = t.radicand AND acc[0].pi_power = t.pi_power)"
    added = _int(f"try_add({_times_int('acc[0].num', 't.den')}, {_times_int('t.num', 'acc[0].den')})")
    sum_ = _term("t.radicand", "t.pi_power", added, _times_int("acc[0].den", "t.den"))
    # The latest term comes first, where it costs nothing to replace it.
    step = case((same, f"concat(array({sum_}), slice(acc, 2, greatest(size(acc) - 1, 0)))"), otherwise="concat(array(t), acc)")
    lowest = let_sql("h", gcd_sql("abs(t.num)", "t.den"), _term("t.radicand", "t.pi_power", "try_divide(t.num, h)", "try_divide(t.den, h)"))
    reduced = f"transform(filter(acc, t -> coalesce(t.num <> 0, true)), t -> CASE WHEN {_known('t')} AND t.den <> 0 THEN {lowest} END)"
    folded = f"aggregate(array_sort(ts), {_terms()}, (acc, t) -> CAST({step} AS {_TYPE}), acc -> reverse({reduced}))"
    sound = let_sql("us", folded, case((f"forall(us, t -> t IS NOT NULL AND {_known('t')})", f"CAST(us AS {_TYPE})")))
    return let_sql("ts", terms, case((f"forall(ts, t -> {_known('t')})", sound)))


def _times(a: str, b: str) -> str:
    """Radicands have their common divisor as a factor of the product in front of the root."""
    product = let_sql(
        "h",
        gcd_sql("x.radicand", "y.radicand"),
        _term(
            _times_int("try_divide(x.radicand, h)", "try_divide(y.radicand, h)"),
            "try_add(x.pi_power, y.pi_power)",
            _times_int(_times_int("x.num", "y.num"), "h"),
            _times_int("x.den", "y.den"),
        ),
    )
    return _merged(f"flatten(transform({a}, x -> transform({b}, y -> {product})))")


def _inverse(t: str) -> str:
    """One over a term: its root goes from below to above."""
    sign = f"CASE WHEN {t}.num < 0 THEN -1 ELSE 1 END"
    return _term(f"{t}.radicand", f"try_subtract(0, {t}.pi_power)", f"{sign} * {t}.den", _times_int(f"abs({t}.num)", f"{t}.radicand"))


def _over(a: str, b: str) -> str:
    one = _terms(_term("1", "0", "1", "1"))
    opposite = _term(f"{b}[1].radicand", f"{b}[1].pi_power", f"-{b}[1].num", f"{b}[1].den")
    conjugate = case((f"size({b}) = 2", f"CAST(array({b}[0], {opposite}) AS {_TYPE})"), otherwise=one)
    fits = f"size({b}) = 1 OR (size({b}) = 2 AND {b}[0].pi_power = {b}[1].pi_power)"
    # Both the top and the divisor times the conjugate, of which the divisor is a single term.
    both = f"transform(array({a}, {b}), s -> {_times('s', 'j')})"
    quotient = let_sql("q", both, case((f"size(q[1]) = 1", _merged(f"transform(q[0], x -> {_single_product('x', _inverse('q[1][0]'))})"))))
    return case((fits, let_sql("j", conjugate, quotient)), otherwise=_NONE)


def _single_product(x: str, inverse: str) -> str:
    """A term times a term without a root, as the inverse of a product with a conjugate is, or times one with the same root."""
    body = let_sql(
        "h",
        gcd_sql(f"{x}.radicand", "y.radicand"),
        _term(
            _times_int(f"try_divide({x}.radicand, h)", "try_divide(y.radicand, h)"),
            f"try_add({x}.pi_power, y.pi_power)",
            _times_int(_times_int(f"{x}.num", "y.num"), "h"),
            _times_int(f"{x}.den", "y.den"),
        ),
    )
    return let_sql("y", inverse, body)


def _whole(a: str) -> str:
    """The whole number that a sum is, else NULL."""
    single = f"size({a}) = 1 AND {a}[0].radicand = 1 AND {a}[0].pi_power = 0 AND {a}[0].den = 1"
    return case((f"size({a}) = 0", _int("0")), (single, f"{a}[0].num"))


def _power(a: str, b: str) -> str:
    """Powers that are whole numbers, from their bits, the highest first; of sums only those from 0."""
    one = _terms(_term("1", "0", "1", "1"))
    square_then_times = f"aggregate(sequence({_BITS}, 0, -1), {one}, (y, i) -> {let_sql('z', _times('y', 'y'), case((f'getbit(abs(x), i) = 1', _times('z', 'base')), otherwise='z'))})"
    base = case(("x >= 0", a), (f"size({a}) = 1", f"CAST(array({_inverse(f'{a}[0]')}) AS {_TYPE})"))
    exponent = let_sql("w", _whole(b), f"CASE WHEN abs(w) < {1 << (_BITS + 1)} THEN CAST(w AS BIGINT) END")
    return let_sql("x", exponent, let_sql("base", base, case(("x IS NOT NULL AND base IS NOT NULL", square_then_times))))


def _square_free(m: str, body: str) -> str:
    """``body`` with ``f.left`` without square factors and ``f.out`` the root of the square that was taken out of ``m``."""
    taken = (
        f"aggregate(sequence(1, {_MULTIPLES}), s, (r, i) -> CASE WHEN r.left % (p * p) = 0 "
        f"THEN named_struct('left', {_int('try_divide(r.left, p * p)')}, 'out', {_times_int('r.out', 'p')}) ELSE r END)"
    )
    start = f"named_struct('left', {_int(m)}, 'out', {_int('1')})"
    stripped = f"aggregate(filter({_SMALL}, p -> {m} % (p * p) = 0), {start}, (s, p) -> {taken})"
    rest = f"aggregate(filter({_SMALL}, p -> s.left % p = 0), s.left, (r, p) -> {_int('try_divide(r, p)')})"
    whole = let_sql(
        "r",
        rest,
        let_sql(
            "w",
            whole_root_sql("r"),
            case(
                ("w IS NOT NULL", f"named_struct('left', {_int('try_divide(s.left, r)')}, 'out', {_times_int('s.out', 'w')})"),
                ("r < 1000000000", "s"),
            ),
        ),
    )
    return let_sql("s", stripped, let_sql("f", whole, body))


def _root(a: str) -> str:
    """Of a ratio and an even power of pi: the root of ``num * den``, over ``den``."""
    found = _terms(_term("f.left", f"{a}[0].pi_power div 2", "f.out", f"{a}[0].den"))
    single = f"size({a}) = 1 AND {a}[0].radicand = 1 AND {a}[0].pi_power % 2 = 0 AND {a}[0].num > 0"
    product = let_sql("m", _times_int(f"{a}[0].num", f"{a}[0].den"), case(("m IS NOT NULL", _square_free("m", case(("f IS NOT NULL", _merged(found)))))))
    return case((f"size({a}) = 0", a), (single, product))


def _number(t: str) -> str:
    digits = _int(f"replace({t}, '.', '')")
    scale = _int(rf"concat('1', repeat('0', length(regexp_extract({t}, r'\.(\d++)$', 1))))")
    return _merged(_terms(_term("1", "0", digits, scale)))


def _negative(a: str) -> str:
    return f"CAST(transform({a}, t -> {_term('t.radicand', 't.pi_power', '-t.num', 't.den')}) AS {_TYPE})"


def _factorial(a: str) -> str:
    product = f"aggregate({up_to_sql('w', _FACTORIALS)}, {_int('1')}, (f, i) -> {_times_int('f', _int('i'))})"
    return let_sql("w", _whole(a), case((f"w BETWEEN 0 AND {_FACTORIALS}", _terms(_term("1", "0", product, "1")))))


_SUMS = Algebra(
    type=_TYPE,
    zero=_terms(),
    one=_terms(_term("1", "0", "1", "1")),
    pi=_terms(_term("1", "1", "1", "1")),
    number=_number,
    plus=lambda a, b: _merged(f"concat({a}, {b})"),
    negative=_negative,
    times=_times,
    over=_over,
    power=_power,
    root=_root,
    nth_root=lambda a, n: _NONE,
    absolute=lambda a: case((f"size({a}) = 1 AND {a}[0].num < 0", _negative(a)), (f"size({a}) <= 1", a)),
    factorial=_factorial,
    binomial=lambda n, k: _NONE,
    function=lambda name, x: _NONE,
    raises=False,
)


def exact_form(text: Column, spark: SparkSession | None = None) -> Column:
    """Exact key of a text in closed form, sums included (see the module); NULL where there is none. Zero is an empty list.

    The expression is nested so deeply that the session's limit on rounds of analysis is raised for it: that of ``spark``, by
    default the one that is active.
    """
    session = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    if int(session.conf.get(_ROUNDS[0])) < _ROUNDS[1]:
        session.conf.set(_ROUNDS[0], str(_ROUNDS[1]))
    key = case((f"c RLIKE r'{ALPHABET}'", evaluate_sql("c", _SUMS)))
    return applied("s", let_sql("c", spelled(normalize_sql("s")), key), text)

r"""Whether two expressions with variables are the same, by identity testing in finite fields.

Both expressions are computed at eight fixed points, each modulo a prime of its own: a variable is a residue made from its name, a division
multiplies with a power of the divisor, and ``\pi`` and values of functions are residues made from what they are of. Equal
expressions agree at every point where both have a value; different ones agree at a point with a chance of their degree over
the prime.

Roots exist for half of all residues. The primes leave 3 on division by 4, so that one of the two roots is a residue with a
root itself; taking that one makes roots of products the products of roots. All primes up to 47 have roots, so that radicals
of ordinary numbers keep their values; a larger one has a root at half of the points. A variable has a root at half of the points: there ``\sqrt{x^2}`` is ``x``, at the
others it is ``-x``, as it should be for a variable of either sign. A point at which some root does not exist doesn't count.

Letters are variables in texts that look like algebra: no more than three letters in a row, and two or three only where an
operator, a bracket or a command occurs too. Any other text is a word.
"""

from __future__ import annotations

from tallymark.functions.grammar import GREEK, Algebra, case, fold_sql, let_sql, spelled, tokens_sql

# The eight largest primes below 2**31 that leave 3 on division by 4 and have roots of all primes up to 47.
_PRIMES = (2147260631, 2146303871, 2143697111, 2143023671,
           2142014111, 2139839231, 2138962271, 2136129551)
# Points that must count on both sides.
_LEAST_POINTS = 2
_TYPE = "struct<r:bigint,twice:bigint>"


def _lanes() -> str:
    """One structure per point: its prime, a number that sets it apart, and the residue of a tenth."""
    each = [f"named_struct('p', {p}L, 'seed', {seed}, 'tenth', {pow(10, -1, p)}L)" for seed, p in enumerate(_PRIMES)]
    return f"array({', '.join(each)})"


# A value is its residue ``r``, NULL where there is none, and twice itself as a number if that is a small whole constant.
def _value(r: str, twice: str = "NULL") -> str:
    return f"named_struct('r', CAST({r} AS BIGINT), 'twice', CAST({twice} AS BIGINT))"


def _to_the(base: str, exponent: str) -> str:
    """A residue to a power from 0, in as many steps as the exponent has bits."""
    bits = f"slice(sequence(0, 31), 1, coalesce(length(bin({exponent})), 32))"
    square = "'b', (s.b * s.b) % l.p"
    product = f"'y', CASE WHEN getbit({exponent}, i) = 1 THEN (s.y * s.b) % l.p ELSE s.y END"
    return f"aggregate({bits}, named_struct('y', 1L, 'b', {base}), (s, i) -> named_struct({product}, {square}), s -> s.y)"


def _hashed(*parts: str) -> str:
    return f"pmod(xxhash64(l.seed, {', '.join(parts)}), l.p)"


def _number(t: str) -> str:
    digits = f"try_cast(replace({t}, '.', '') AS DECIMAL(38,0))"
    scale = rf"length(regexp_extract({t}, r'\.(\d++)$', 1))"
    whole = f"CAST({digits} % l.p AS BIGINT)"
    # Most numbers have no point, and no power of a tenth to be computed at every one of the points.
    residue = case((f"NOT contains({t}, '.')", whole), otherwise=f"({whole} * {_to_the('l.tenth', scale)}) % l.p")
    twice = f"try_cast({t} AS DECIMAL(12,1)) * 2"
    exact = f"CASE WHEN try_cast({t} AS DECIMAL(38,18)) = try_cast({t} AS DECIMAL(12,1)) AND {twice} = floor({twice}) THEN try_cast({twice} AS BIGINT) END"
    return _value(residue, exact)


def _plus(a: str, b: str) -> str:
    return _value(f"({a}.r + {b}.r) % l.p", f"try_add({a}.twice, {b}.twice)")


def _negative(a: str) -> str:
    return _value(f"(l.p - {a}.r) % l.p", f"try_subtract(0L, {a}.twice)")


def _times(a: str, b: str) -> str:
    product = f"CASE WHEN {a}.twice % 2 = 0 THEN try_multiply({a}.twice div 2, {b}.twice) WHEN {b}.twice % 2 = 0 THEN try_multiply({a}.twice, {b}.twice div 2) END"
    return _value(f"({a}.r * {b}.r) % l.p", product)


def _over(a: str, b: str) -> str:
    doubled, divisor = f"try_multiply({a}.twice, 2L)", f"nullif({b}.twice, 0L)"
    quotient = f"CASE WHEN {doubled} % {divisor} = 0 THEN {doubled} div {divisor} END"
    inverse = _to_the(f"{b}.r", "l.p - 2")
    return _value(case((f"{b}.r <> 0", f"({a}.r * {inverse}) % l.p")), quotient)


def _root_of(r: str) -> str:
    """The root that has a root itself; NULL where there is none."""
    return case((f"{r} = 0", "0L"), (f"{_to_the(r, '(l.p - 1) div 2')} = 1", _to_the(r, "(l.p + 1) div 4")))


def _power(a: str, b: str) -> str:
    """Powers that are whole numbers or halves of them; others are none."""
    whole = f"pmod({b}.twice div 2, l.p - 1)"
    half = let_sql("h", _root_of(f"{a}.r"), case(("h <> 0", _to_the("h", f"pmod({b}.twice, l.p - 1)"))))
    residue = case(
        (f"{b}.twice IS NULL", "NULL"),
        (f"{a}.r = 0", f"CASE WHEN {b}.twice > 0 THEN 0L WHEN {b}.twice = 0 THEN 1L END"),
        (f"{b}.twice % 2 = 0", _to_the(f"{a}.r", whole)),
        otherwise=half,
    )
    power = f"pow({a}.twice / 2, {b}.twice / 2)"
    whole_power = f"{a}.twice % 2 = 0 AND {b}.twice % 2 = 0 AND {b}.twice >= 0 AND abs({power}) < 1e9"
    return _value(residue, f"CASE WHEN {whole_power} THEN try_cast({power} * 2 AS BIGINT) END")


def _absolute(a: str) -> str:
    """Of a constant its absolute value; else a residue that ``x`` and ``-x`` share."""
    known = f"CASE WHEN {a}.twice < 0 THEN (l.p - {a}.r) % l.p WHEN {a}.twice >= 0 THEN {a}.r ELSE {_hashed('1', f'({a}.r * {a}.r) % l.p')} END"
    return _value(case((f"{a}.r IS NOT NULL", known)), f"abs({a}.twice)")


def _factorial(a: str) -> str:
    whole = f"{a}.twice % 2 = 0 AND {a}.twice BETWEEN 0 AND 40"
    product = f"aggregate(slice(sequence(1L, 20L), 1, CAST({a}.twice div 2 AS INT)), 1L, (f, i) -> f * i)"
    residue = case((f"{a}.r IS NULL", "NULL"), (whole, f"{product} % l.p"), otherwise=_hashed("2", f"{a}.r"))
    return _value(residue)


def _opaque(mark: str, *values: str) -> str:
    known = " AND ".join(f"{v}.r IS NOT NULL" for v in values)
    return _value(case((known, _hashed(mark, *(f"{v}.r" for v in values)))))


_RESIDUES = Algebra(
    type=_TYPE,
    zero=_value("0L", "0L"),
    one=_value("1L", "2L"),
    pi=_value(_hashed("'pi'")),
    number=_number,
    plus=_plus,
    negative=_negative,
    times=_times,
    over=_over,
    power=_power,
    root=lambda a: _value(_root_of(f"{a}.r")),
    nth_root=lambda a, n: _value("NULL"),
    absolute=_absolute,
    factorial=_factorial,
    binomial=lambda n, k: _opaque("'choose'", n, k),
    function=lambda name, x: _opaque(rf"regexp_replace({name}, r'[({{]$', '')", x),
    raises=False,
    variable=lambda t: _value(_hashed("translate(t, '{}', '')")),
)

_COMMAND = r"\\[A-Za-z]++"


def is_algebra_sql(text: str) -> str:
    """Whether a normalised text looks like algebra rather than words."""
    plain = rf"regexp_replace({text}, r'{_COMMAND}|_\{{[A-Za-z0-9]++\}}|_[A-Za-z0-9]', ' ')"
    return (
        rf"({text} RLIKE r'[A-Za-z]' AND ({plain} RLIKE r'[A-Za-z]' OR {text} RLIKE r'\\(?:{GREEK})') AND NOT {plain} RLIKE r'[A-Za-z]{{4}}' AND "
        rf"(NOT {plain} RLIKE r'[A-Za-z]{{2}}|[A-Za-z] ++[A-Za-z]' OR {text} RLIKE r'[-+*/^(){{|!\\]'))"
    )


def residues_sql(normalized: str) -> str:
    """The residues of a text with variables that was normalised already, point by point; NULL for other texts."""
    at_points = f"transform({_lanes()}, l -> {fold_sql('xs', _RESIDUES)}.r)"
    tokens = tokens_sql("c", variables=True)
    found = let_sql("xs", tokens, case(("xs IS NOT NULL", at_points)))
    return case((is_algebra_sql(normalized), let_sql("c", spelled(normalized), found)))


def agree_sql(left: str, right: str) -> str:
    """Whether two lists of residues are the same wherever both have one, and both have enough."""
    same = f"zip_with({left}, {right}, (x, y) -> CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN x = y END)"
    return let_sql("ys", same, f"(size(filter(ys, y -> y)) >= {_LEAST_POINTS} AND NOT exists(ys, y -> coalesce(NOT y, false)))")

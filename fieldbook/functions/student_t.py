"""Student's t distribution as column expressions.

Spark has no t distribution. Its tails are a regularised incomplete beta function, here a continued
fraction folded over a sequence of steps (modified Lentz method), so no Python worker is needed. The expressions
are written as SQL text, which Spark parses in one call. Arguments are column names or SQL text; every function is NULL
where an argument is, or where the degrees of freedom are not above 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NEWTON_STEPS = 80
# Half steps of the fraction. With 1/2 as one parameter, doubles keep still after some hundred, whatever the other is.
_FRACTION_STEPS = 200
# Adding so little changes nothing but a zero.
_TINY = "1e-300D"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a value that is computed once however often the body names it."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _gamma_step(a: str) -> str:
    """ln Gamma(a + 1/2) - ln Gamma(a), as one difference so that large terms do not cancel."""
    rest = lambda z: f"(1 / (12 * {z}) - 1 / (360 * pow({z}, 3)) + 1 / (1260 * pow({z}, 5)))"
    far = f"z * log1p(0.5D / z) + 0.5D * ln(z) - 0.5D + {rest('(z + 0.5D)')} - {rest('z')}"
    near = f"aggregate(sequence(0, 9), 0D, (sum, k) -> sum + log1p(-0.5D / ({a} + k + 0.5D)))"
    return f"({_let('z', f'{a} + 10D', far)} + {near})"


def _fraction(p: str, q: str, z: str) -> str:
    """Continued fraction of the incomplete beta function, one parameter of which is 1/2."""
    top = "IF(j % 2 = 0, shiftright(j, 1) * (f.q - shiftright(j, 1)), -(f.p + shiftright(j, 1)) * (f.p + f.q + shiftright(j, 1)))"
    term = f"{top} * f.z / ((f.p + j - 1) * (f.p + j))"
    step = f"named_struct('c', 1 + w / s.c + {_TINY}, 'd', 1 / (1 + w * s.d + {_TINY}), 'total', s.total * s.c * s.d)"
    start = f"named_struct('c', 1D, 'd', 1 / (1 - (f.p + f.q) * f.z / (f.p + 1) + {_TINY}), 'total', 1D)"
    folded = f"aggregate(sequence(2, {_FRACTION_STEPS}), {start}, (s, j) -> {_let('w', term, step)}, s -> s.total * s.c * s.d)"
    return _let("f", f"named_struct('p', {p}, 'q', {q}, 'z', {z})", folded)


def _both_tails(t: str, df: str) -> str:
    """P(|T| > |t|) of plain names."""
    front = f"exp({_gamma_step('b.a')} - 0.5D * ln(pi()) - b.a * log1p(b.square / {df}) + 0.5D * ln(b.y))"
    fraction = _fraction("IF(b.low, b.a, 0.5D)", "IF(b.low, 0.5D, b.a)", "IF(b.low, b.x, b.y)")
    tails = _let("part", f"{front} * {fraction} / IF(b.low, b.a, 0.5D)", "IF(b.low, part, 1 - part)")
    square = f"{t} * {t}"
    low = f"{df} / ({df} + {square}) < ({df} / 2 + 1) / ({df} / 2 + 2.5D)"
    parts = f"named_struct('a', {df} / 2, 'square', {square}, 'x', {df} / ({df} + {square}), 'y', {square} / ({df} + {square}), 'low', {low})"
    return _let("b", parts, f"CASE WHEN b.square = 0 THEN 1D WHEN b.square = double('infinity') THEN 0D ELSE {tails} END")


def _given(value: str, df: str, body: str) -> Column:
    """``body`` in terms of ``g.value`` and ``g.df``."""
    pair = f"named_struct('value', CAST({value} AS DOUBLE), 'df', CAST({df} AS DOUBLE))"
    return F.expr(_let("g", pair, f"IF(g.value IS NOT NULL AND g.df > 0, {body}, NULL)"))


def t_two_sided(t: str, df: str) -> Column:
    """P(|T| > |t|)."""
    return _given(t, df, _both_tails("g.value", "g.df"))


def t_upper_tail(t: str, df: str) -> Column:
    """P(T > t)."""
    return _given(t, df, _let("half", _both_tails("g.value", "g.df") + " / 2", "IF(g.value >= 0, half, 1 - half)"))


def t_quantile(p: str, df: str) -> Column:
    """t with P(T <= t) = p, for p above 0 and below 1.

    Newton's method from 0 on the side of p: the distribution is concave there, so no step passes the
    quantile, and the steps end at the precision of doubles.
    """
    density = "exp(h.constant - (g.df + 1) / 2 * log1p(n.t * n.t / g.df))"
    move = f"(h.upper - 1 + {_both_tails('n.t', 'g.df')} / 2) / {density}"
    moved = _let("by", move, "named_struct('t', n.t + by, 'done', abs(by) <= 1e-14D * abs(n.t + by))")
    found = f"aggregate(sequence(1, {_NEWTON_STEPS}), named_struct('t', 0D, 'done', h.upper = 0.5D), (n, i) -> IF(n.done, n, {moved}), n -> n.t)"
    constant = f"{_gamma_step('(g.df / 2)')} - 0.5D * ln(g.df * pi())"
    solved = _let("h", f"named_struct('upper', greatest(g.value, 1 - g.value), 'constant', {constant})", found)
    return _given(p, df, f"IF(g.value > 0 AND g.value < 1, {_let('t', solved, 'IF(g.value < 0.5D, -t, t)')}, NULL)")

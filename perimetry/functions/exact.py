"""The sign of a turn, exact, as a Spark expression.

A determinant in doubles is trusted where it exceeds its rounding error. Elsewhere it is expanded without
error: each difference and product becomes a sum of doubles (error-free transformations), and the sum of
all of them is brought into an expansion whose last part other than zero has the sign of the whole.
The expression is SQL text, as a tree of its size takes seconds to build call by call.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAMES = (f"v{n}" for n in count())


def _let(value: str, use) -> str:
    """``use(name)`` with ``value`` evaluated once."""
    name = next(_NAMES)
    return f"transform(array({value}), {name} -> {use(name)})[0]"


def _pair(high: str, low: str) -> str:
    return f"named_struct('high', {high}, 'low', {low})"


def _sum(a: str, b: str) -> str:
    """a + b as high and low part; ``a`` and ``b`` are names."""
    return _let(f"{a} + {b}", lambda s: _let(f"{s} - {a}", lambda t: _pair(s, f"({a} - ({s} - {t})) + ({b} - {t})")))


def _halves(v: str) -> str:
    """A double as two of half its length."""
    return _let(f"{v} * 134217729D", lambda c: _let(f"{c} - ({c} - {v})", lambda h: _pair(h, f"{v} - {h}")))


def _product(a: str, b: str) -> str:
    """a * b as an array of high and low part."""

    def low(p: str, x: str, y: str) -> str:
        return f"{x}.low * {y}.low - ((({p} - {x}.high * {y}.high) - {x}.low * {y}.high) - {x}.high * {y}.low)"

    return _let(_halves(a), lambda x: _let(_halves(b), lambda y: _let(f"{a} * {b}", lambda p: f"array({p}, {low(p, x, y)})")))


def _exact(ax: str, ay: str, bx: str, by: str, cx: str, cy: str) -> str:
    def difference(a: str, b: str) -> str:
        return _let(f"CAST({a} AS DOUBLE)", lambda x: _let(f"-CAST({b} AS DOUBLE)", lambda y: _sum(x, y)))

    def products(d: str, i: int, j: int, sign: str) -> str:
        """All parts of sign * d[i] * d[j]."""
        return ", ".join(
            _let(f"{sign}{d}[{i}].{u}", lambda x, v=v: _let(f"{d}[{j}].{v}", lambda y: _product(x, y)))
            for u in ("high", "low") for v in ("high", "low"))

    grown = (
        "aggregate(e, named_struct('done', CAST(array() AS ARRAY<DOUBLE>), 'rest', b), (s, x) -> "
        + _let("s.rest", lambda r: _let(_sum(r, "x"), lambda t: f"named_struct('done', concat(s.done, array({t}.low)), 'rest', {t}.high)"))
        + ", s -> concat(s.done, array(s.rest)))"
    )

    def sign(parts: str) -> str:
        expansion = f"aggregate({parts}, CAST(array() AS ARRAY<DOUBLE>), (e, b) -> {grown})"
        return f"coalesce(signum(try_element_at(filter({expansion}, z -> z != 0), -1)), 0D)"

    differences = ", ".join((difference(bx, ax), difference(cy, ay), difference(by, ay), difference(cx, ax)))
    return _let(f"array({differences})", lambda d: sign(f"concat({products(d, 0, 1, '')}, {products(d, 2, 3, '-')})"))


def turn(ax: str, ay: str, bx: str, by: str, cx: str, cy: str) -> Column:
    """1 if a, b, c turn left, -1 if right, 0 if they are in line; the arguments are names of double columns."""
    left, right = f"(({bx} - {ax}) * ({cy} - {ay}))", f"(({by} - {ay}) * ({cx} - {ax}))"
    at_end = f"(({cx} = {ax} AND {cy} = {ay}) OR ({cx} = {bx} AND {cy} = {by}))"
    level = f"(({bx} = {ax} OR {cy} = {ay}) AND ({by} = {ay} OR {cx} = {ax}))"
    # forward error bound of a 2x2 determinant of differences in double precision
    return F.expr(
        f"CASE WHEN abs({left} - {right}) > 3.3306690738754716E-16D * (abs({left}) + abs({right})) THEN signum({left} - {right})"
        f" WHEN {at_end} OR {level} THEN 0D ELSE {_exact(ax, ay, bx, by, cx, cy)} END")

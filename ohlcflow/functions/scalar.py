"""Scalar and array functions (F1-F11), all Catalyst expressions.

They accept Columns or Python numbers, so a fixed model folds to literals and
a per-symbol model reads joined columns; either way the expression stays in
whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: offset added inside the logistic function before exponentiation.
SIGMOID_EPS = 1e-12


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def sigmoid(x) -> Column:
    """1 / (1 + exp(-(x + 1e-12)))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(_c(x) + F.lit(SIGMOID_EPS))))


def minmax_scale(x, lo, hi) -> Column:
    """(x - min) / (max - min); a constant column scales to 0."""
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def minmax_inverse(y, lo, hi) -> Column:
    """y * (max - min) + min."""
    y, lo, hi = _c(y), _c(lo), _c(hi)
    return y * (hi - lo) + lo


def dot(xs, ws) -> Column:
    """inner product of two equally long vectors.

    Python lists unroll to a sum of products (constant folding for literal
    weights); array Columns use ``zip_with`` + ``aggregate``.
    """
    if isinstance(xs, (list, tuple)) and isinstance(ws, (list, tuple)):
        return reduce(lambda a, b: a + b, [_c(x) * _c(w) for x, w in zip(xs, ws)])
    if isinstance(ws, (list, tuple)):
        return reduce(lambda a, b: a + b, [xs[k] * _c(w) for k, w in enumerate(ws)])
    return F.aggregate(F.zip_with(xs, ws, lambda a, b: a * b), F.lit(0.0),
                       lambda acc, v: acc + v)


def round_half_up(x, digits: int = 3) -> Column:
    """F8: rounding to ``digits`` places."""
    return F.round(_c(x), digits)


def parse_bar_time(s) -> Column:
    """bar times as written by brokers and files.

    Accepts ``2021-11-15 13:55:00+00:00``, ``2021-11-15T13:55:00Z`` and
    ``2021-11-15 13:55:00`` (UTC), each with one to nine digits of a second;
    the result is a UTC instant (microseconds), null for anything else.
    """
    s = _c(s)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in (
        "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX", "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]")])


def reshape_steps(xs) -> Column:
    """(steps) -> (steps, 1), i.e. one feature per time step."""
    return F.transform(_c(xs), lambda x: F.array(x))

"""Vector arithmetic as Column builders over ``array<float|double>``.

All of them stay in the JVM.  A value that a higher-order function uses for
every element (a norm, say) is bound once with :func:`bind`; written inline it
would be evaluated again per element, which is quadratic in the dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumora.fixed_values import STORED_DECIMALS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def vector_literal(values: Sequence[float]) -> Column:
    return F.lit([float(x) for x in values]).cast("array<double>")


def l2_norm(v: Column | str) -> Column:
    """Euclidean norm, summed left to right in double precision."""
    return F.sqrt(F.aggregate(
        _col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column | str) -> Column:
    """Divide by the norm; a norm of zero or NaN counts as one."""
    v = _col(v)
    norm = l2_norm(v)
    safe = bind(norm, lambda n: F.when((n == 0.0) | F.isnan(n), F.lit(1.0)).otherwise(n))
    return bind(safe, lambda n: F.transform(v, lambda x: x.cast("double") / n))


def quantize(v: Column | str, decimals: int = STORED_DECIMALS) -> Column:
    """Round every component, halves towards plus infinity."""
    scale = float(10 ** decimals)

    def rounded(x: Column) -> Column:
        scaled = x.cast("double") * scale
        whole = F.floor(scaled).cast("double")
        return (whole + F.when(scaled - whole >= 0.5, 1.0).otherwise(0.0)) / scale

    return F.transform(_col(v), rounded)


def to_float32(v: Column | str) -> Column:
    return _col(v).cast("array<float>")


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product over the shorter length; a missing vector counts as empty.

    Components are widened to double before they are multiplied.
    """
    a = F.coalesce(_col(a), F.array().cast("array<double>"))
    b = F.coalesce(_col(b), F.array().cast("array<double>"))

    def total(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)

    shared = F.least(F.size(a), F.size(b))
    return F.when(F.size(a) == F.size(b), total(a, b)).otherwise(
        total(F.slice(a, F.lit(1), shared), F.slice(b, F.lit(1), shared)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of unit vectors, which is their dot product."""
    return dot(a, b)


def subtract(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))


def orderable(score: Column | str) -> Column:
    """NaN becomes NULL so that ``desc_nulls_last`` puts it at the end."""
    score = _col(score)
    return F.when(F.isnan(score), F.lit(None)).otherwise(score)

"""Dense-vector expressions on ``array<double>`` columns.

Higher-order functions keep the work in the JVM; the Arrow path in
:mod:`quarry.operators.blocked` is used where a whole block of rows meets a
whole block of rows (matrix products).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, t: s + t)


def sq_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)


def norm(a: Column) -> Column:
    return F.sqrt(sq_norm(a))


def normalize(a: Column) -> Column:
    """Unit vector; a zero vector gives NULL (``try_divide``) and is then
    excluded from matching instead of dividing by zero."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: F.try_divide(x, n)))


def l2_direct(a: Column, b: Column) -> Column:
    """Euclidean distance by the difference form."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, t: s + t))

"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, in double precision; 0 where a norm is 0, NULL for NULL."""
    dot = _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norms = F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))) * _sum(F.transform(b, lambda x: x.cast("double") * x.cast("double"))))
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.coalesce(F.try_divide(dot, norms), F.lit(0.0)))

"""Vector functions over arrays of floats, inside the JVM, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from siltstone.functions.text import col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column | str) -> Column:
    """The vector over its norm, or over 1e-12 if that is larger."""
    length = F.greatest(norm(v), F.lit(1e-12))
    return F.transform(col(v), lambda x: x.cast("double") / length)


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(1e-12)) * F.greatest(norm(b), F.lit(1e-12)))


def min_max(c: Column | str, *by: str) -> Column:
    """Scores of a group scaled to 0..1; all 1 if they are equal."""
    w = Window.partitionBy(*by)
    low, high = F.min(col(c)).over(w), F.max(col(c)).over(w)
    return F.when(low == high, 1.0).otherwise((col(c) - low) / (high - low))

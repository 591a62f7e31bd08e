"""Arithmetic on dense vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cosine(a: Column | str, b: Column | str) -> Column:
    """Inner product in double; the cosine where both vectors have unit length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

"""Vector maths on array columns, without Python in the path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda x: x * factor)


def add(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: x + y)


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(values: Column) -> Column:
    return F.sqrt(dot(values, values))


def unit(values: Column) -> Column:
    """Vector of length one; a zero vector stays as it is.

    The length is worked out once per vector; named inside the inner function, it would be worked out per component.
    """

    def divided(length: Column) -> Column:
        return F.when(length > 0, F.transform(values, lambda x: x / length)).otherwise(
            F.transform(values, lambda x: x.cast("double"))
        )

    return F.transform(F.array(norm(values)), divided)[0]


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; 0 when either vector has no length."""
    return F.coalesce(F.try_divide(dot(left, right), norm(left) * norm(right)), F.lit(0.0))

"""Aggregates whose result does not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.sum(c.cast("decimal(18,4)"))


def exact_mean(column: str | Column) -> Column:
    """Mean from an exact decimal sum: retries and repartitioning cannot change it."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(exact_sum(c).cast("double"), F.count(c).cast("double"))


def code_count(column: str | Column) -> Column:
    """Distinct values of a code column, whose domain is fixed and small.

    The values fit in the aggregation buffer, so several such counts need one shuffle
    and no copy of the rows per count. Use ``count_distinct`` for open domains.
    """
    return F.size(F.collect_set(column)).cast("long")


def share(condition: Column) -> Column:
    """Share of rows for which the condition holds; null counts as no."""
    hits = F.count(F.when(condition, 1)).cast("double")
    return F.try_divide(hits, F.count(F.lit(1)).cast("double"))


def smallest_mode(values: str, counts: str) -> Column:
    """Most frequent value over pre-counted rows, the smallest one on ties."""
    return F.min_by(values, F.struct(-F.col(counts), F.col(values)))

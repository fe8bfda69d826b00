"""Data-quality checks: one pass over the clicks, long results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.functions.aggregates import exact_mean


def long_form(df: DataFrame, columns: dict[str, Column], name: str, value: str) -> DataFrame:
    """One-row frame to one row per entry of ``columns``."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in columns.items()])
    return df.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return long_form(counted, {c: F.col(c) for c in df.columns}, "column", "nulls")


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct non-null values per column, counted over (column, value) pairs."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column")
        .agg(F.count_distinct("value").alias("distinct_values"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def contract_checks(
    df: DataFrame, required: Sequence[str], expected_distinct: dict[str, int], rows: int | None = None
) -> DataFrame:
    """Checks on the input as (check, found, ok) rows, from a single aggregate."""
    expected_rows = F.col("rows") > 0 if rows is None else F.col("rows") == rows
    measures = [F.count(F.lit(1)).alias("rows")]
    checks = {"rows": (F.col("rows"), expected_rows)}
    for c in required:
        measures.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
        checks[f"{c} never null"] = (F.col(f"null_{c}"), F.col(f"null_{c}") == 0)
    for c, n in expected_distinct.items():
        measures.append(F.count_distinct(c).alias(f"distinct_{c}"))
        checks[f"{c} distinct"] = (F.col(f"distinct_{c}"), F.col(f"distinct_{c}") == n)
    structs = [
        F.struct(F.lit(k).alias("check"), found.cast("long").alias("found"), ok.alias("ok"))
        for k, (found, ok) in checks.items()
    ]
    return df.agg(*measures).select(F.inline(F.array(*structs)))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column."""
    measures = []
    for c in columns:
        measures += [
            F.count(c).alias(f"count_{c}"),
            exact_mean(c).alias(f"mean_{c}"),
            F.stddev(c).alias(f"stddev_{c}"),
            F.min(c).cast("double").alias(f"min_{c}"),
            F.max(c).cast("double").alias(f"max_{c}"),
        ]
    stats = ["count", "mean", "stddev", "min", "max"]
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}_{c}").alias(s) for s in stats]) for c in columns
    ]
    return df.agg(*measures).select(F.inline(F.array(*structs)))


def transpose_row(one_row: DataFrame, name: str = "key", value: str = "value") -> DataFrame:
    """A one-row frame as (name, value) rows, values as doubles."""
    entries = {c: F.col(c).cast("double") for c in one_row.columns}
    return long_form(one_row, entries, name, value)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)

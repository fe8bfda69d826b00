"""Profiles of groups: clusters, topics, communities or any other key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmill.functions.aggregates import exact_mean, smallest_mode
from trailmill.scale import exact_percentiles, materialise
from trailmill.schema import ITEM, SESSION


def value_counts(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Rows per (group, column, value): counted before the shuffle, whatever the group sizes."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(group, F.inline(pairs)).groupBy(group, "column", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def group_modes(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of every column per group, with diversity and group size."""
    return (
        value_counts(df, group, columns)
        .groupBy(group, "column")
        .agg(
            smallest_mode("value", "rows").alias("mode"),
            F.max("rows").alias("mode_rows"),
            F.count("value").alias("distinct_values"),
            F.sum("rows").alias("group_rows"),
        )
    )


def group_profile(df: DataFrame, group: str) -> DataFrame:
    """Price statistics, size, page depth and photo share of each group."""
    used = [group, SESSION, "price", "page", "photo_type", ITEM, "category", "colour", "country"]
    df = materialise(df.select(used))
    stats = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(SESSION).alias("sessions"),
        exact_mean("price").alias("avg_price"),
        F.stddev("price").alias("price_std"),
        exact_mean("page").alias("avg_page"),
        exact_mean(F.col("photo_type") - 1).alias("photo_share"),
    )
    spread = exact_percentiles(
        df, "price", {"p05": 0.05, "q1": 0.25, "median_price": 0.5, "q3": 0.75, "p95": 0.95}, [group]
    )
    modes = (
        group_modes(df, group, [ITEM, "category", "colour", "country"])
        .groupBy(group)
        .agg(
            *[
                F.max(F.when(F.col("column") == c, F.col(source))).alias(f"{name}_{c}")
                for c in (ITEM, "category", "colour", "country")
                for name, source in (("top", "mode"), ("n", "distinct_values"))
            ]
        )
    )
    prices = (
        df.groupBy(group, "price").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(group).agg(smallest_mode("price", "rows").alias("top_price"))
    )
    return stats.join(spread, group).join(modes, group).join(prices, group)


def distinct_rows(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the columns per group."""
    return df.groupBy(group).agg(F.count_distinct(*columns).alias("distinct_rows"))


def group_members(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column per group, one row per value."""
    return value_counts(df, group, columns).select(group, "column", "value")


def code_sets(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Sorted arrays of the values of code columns, whose domains are fixed and small."""
    return df.groupBy(group).agg(
        *[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"{c}_set") for c in columns]
    )


def top_values(df: DataFrame, group: str, column: str, n: int) -> DataFrame:
    """The n most clicked values of a column per group; ties go to the smaller value."""
    counts = df.groupBy(group, column).agg(F.count(F.lit(1)).alias("clicks"))
    w = Window.partitionBy(group).orderBy(F.desc("clicks"), F.asc(column))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def dominant_value(df: DataFrame, group: str, column: str) -> DataFrame:
    """The most frequent value per group, by a plain aggregate over counted values."""
    counts = df.groupBy(group, column).agg(F.count(F.lit(1)).alias("clicks"))
    return counts.groupBy(group).agg(
        smallest_mode(column, "clicks").alias(column), F.max("clicks").alias("clicks")
    )


def scaled_counts(df: DataFrame, group: str, column: str, n: int) -> DataFrame:
    """Top values per group with their count relative to the group's largest."""
    top = top_values(df, group, column, n)
    largest = F.max("clicks").over(Window.partitionBy(group))  # at most n rows
    return top.withColumn("scaled", F.col("clicks").cast("double") / largest)


def pair_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("clicks"))


def sample_per_group(df: DataFrame, group: str, key: Sequence[str], n: int, seed: int) -> DataFrame:
    """n pseudo-random rows per group, ordered by a seeded hash of the row key."""
    order = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in key]).cast("binary"))
    w = Window.partitionBy(group).orderBy(order, *key)
    return df.withColumn("pick", F.row_number().over(w)).filter(F.col("pick") <= n)

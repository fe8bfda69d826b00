"""Exploratory aggregates over clicks and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.functions.aggregates import code_count, exact_mean, share
from trailmill.scale import exact_percentiles, materialise
from trailmill.schema import ITEM, SESSION


def dataset_totals(clicks: DataFrame) -> DataFrame:
    return clicks.agg(
        F.count(F.lit(1)).alias("clicks"),
        F.count_distinct(SESSION).alias("sessions"),
        F.count_distinct(ITEM).alias("products"),
        code_count("category").alias("categories"),
        code_count("country").alias("countries"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        exact_mean("price").alias("avg_price"),
    )


def region_activity(clicks: DataFrame) -> DataFrame:
    per_session = F.try_divide(F.col("clicks").cast("double"), F.col("sessions"))
    return (
        clicks.groupBy("region")
        .agg(F.count(F.lit(1)).alias("clicks"), F.count_distinct(SESSION).alias("sessions"))
        .withColumn("clicks_per_session", F.round(per_session, 2))
    )


def popularity(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks and distinct sessions per key."""
    return clicks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clicks"), F.count_distinct(SESSION).alias("sessions")
    )


def top_rows(df: DataFrame, score: str, ties: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(F.desc(score), *ties).limit(n)


def count_pivot(clicks: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Click counts with one column per given value; missing cells are 0."""
    return clicks.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def key_counts(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks per value of each key, as (key, value, clicks) rows from one scan."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]
    )
    return clicks.select(F.inline(pairs)).groupBy("key", "value").agg(F.count(F.lit(1)).alias("clicks"))


def value_summary(df: DataFrame, value: str) -> DataFrame:
    """Minimum, quartiles, maximum and mean; exact."""
    low, high, mean = df.agg(F.min(value), F.max(value), exact_mean(value)).first()
    quartiles = exact_percentiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return quartiles.select(
        F.lit(low).cast("double").alias("low"),
        "q1",
        "median",
        "q3",
        F.lit(high).cast("double").alias("high"),
        F.lit(mean).alias("mean"),
    )


def approx_summary(df: DataFrame, value: str, accuracy: int = 10_000) -> DataFrame:
    """Quartiles from a mergeable sketch: one pass, for use when exactness is not needed."""
    q = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return df.agg(q.alias("q")).select(
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )


#: Three standard errors of a distinct count with 2^12 registers, and the rank error of a quantile sketch of size 200.
REGISTERS = 12
COUNT_ERROR = 3 * 1.04 / 64
RANK_ERROR = 0.0165


def activity_sketches(df: DataFrame, keys: list[str], counted: str, value: str) -> DataFrame:
    """A distinct-count and a quantile sketch per key, to be stored and merged by any coarser key."""
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(counted, REGISTERS).alias("distinct_sketch"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("value_sketch")
    )


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated distinct count and quartiles per coarser key, from stored sketches alone."""
    merged = sketches.groupBy(*keys).agg(
        F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("value_sketch").alias("v")
    )
    quantile = lambda q: F.kll_sketch_get_quantile_double("v", F.lit(q))
    return merged.select(
        *keys, F.hll_sketch_estimate("d").alias("sessions_estimate"), quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3")
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value."""
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    width = F.try_divide(F.col(value) - F.lit(low), F.lit(high) - F.lit(low))
    bin_no = F.least(F.floor(F.coalesce(width, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
    )


def price_preference(clicks: DataFrame, keys: Sequence[str] = (), premium: str = "price_above_avg") -> DataFrame:
    return clicks.groupBy(*keys).agg(
        share(F.col(premium)).alias("share_above_avg"),
        exact_mean("price").alias("avg_price"),
        F.count(F.lit(1)).alias("clicks"),
    )


def session_depth(features: DataFrame) -> DataFrame:
    """Mean and median clicks and deepest page, and the page-1-only share."""
    features = materialise(features.select("n_clicks", "max_page"))
    row = features.agg(
        exact_mean("n_clicks").alias("avg_clicks"),
        exact_mean("max_page").alias("avg_max_page"),
        share(F.col("max_page") == 1).alias("share_page1_only"),
    )
    measures = F.array(
        F.struct(F.lit("clicks").alias("measure"), F.col("n_clicks").cast("double").alias("x")),
        F.struct(F.lit("page").alias("measure"), F.col("max_page").cast("double").alias("x")),
    )
    medians = exact_percentiles(features.select(F.inline(measures)), "x", {"median": 0.5}, ["measure"])
    found = {r["measure"]: r["median"] for r in medians.collect()}  # two rows
    return row.select(
        "avg_clicks",
        F.lit(found.get("clicks")).alias("median_clicks"),
        "avg_max_page",
        F.lit(found.get("page")).alias("median_max_page"),
        "share_page1_only",
    )


def session_distribution(features: DataFrame, measure: str) -> DataFrame:
    """Sessions per value of a session measure."""
    return features.groupBy(measure).agg(F.count(F.lit(1)).alias("sessions"))


def sessions_per(clicks: DataFrame, key: str) -> DataFrame:
    return clicks.groupBy(key).agg(F.count_distinct(SESSION).alias("sessions"))


def sparsity(clicks: DataFrame) -> DataFrame:
    """Share of empty cells of the session-by-item matrix.

    Items and sessions are counted on the distinct pairs, so the clicks are
    shuffled once.
    """
    pairs = clicks.select(SESSION, ITEM).distinct()
    counted = pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_distinct(SESSION).alias("sessions"),
        F.count_distinct(ITEM).alias("items"),
    )
    cells = F.col("sessions").cast("double") * F.col("items")
    return counted.withColumn("sparsity", 1 - F.try_divide(F.col("pairs").cast("double"), cells))


def session_shares(features: DataFrame) -> DataFrame:
    """Single-click and multi-category shares, and mean, median and longest session."""
    features = materialise(features.select("n_clicks", "n_categories"))
    row = features.agg(
        share(F.col("n_clicks") == 1).alias("single_click_share"),
        share(F.col("n_categories") > 1).alias("multi_category_share"),
        exact_mean("n_clicks").alias("mean_clicks"),
        F.max("n_clicks").alias("max_clicks"),
    )
    median = exact_percentiles(features, "n_clicks", {"median": 0.5}).first()["median"]
    return row.withColumn("median_clicks", F.lit(median))


def sessions_by_date(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("click_date").agg(F.count(F.lit(1)).alias("sessions"))


def date_range(clicks: DataFrame) -> DataFrame:
    return clicks.agg(F.min("click_date").alias("first_date"), F.max("click_date").alias("last_date"))


def summary_row(clicks: DataFrame) -> DataFrame:
    """Totals with the leading region (by sessions), category and colour (by clicks).

    One long scan feeds all three rankings: every click yields a (dimension, value)
    pair, and the winner of each dimension is picked on the counted values. Sessions are told apart for
    regions only, which are ranked by them.
    """
    dims = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
            for d in ("region", "category", "colour")
        ]
    )
    counted = (
        clicks.select(SESSION, F.inline(dims))
        .groupBy("dimension", "value")
        .agg(
            F.count(F.lit(1)).alias("clicks"),
            F.count_distinct(F.when(F.col("dimension") == "region", F.col(SESSION))).alias("sessions"),
        )
    )
    measure = F.when(F.col("dimension") == "region", F.col("sessions")).otherwise(F.col("clicks"))
    best = counted.withColumn("measure", measure).groupBy("dimension").agg(
        F.min_by("value", F.struct(-F.col("measure"), F.col("value"))).alias("winner"),
        F.max("measure").alias("top"),
        F.sum("clicks").alias("clicks"),
    )

    def of(dimension: str, column: str):
        return F.max(F.when(F.col("dimension") == dimension, F.col(column)))

    return best.agg(
        F.max("clicks").alias("clicks"),
        of("region", "winner").alias("top_region"),
        of("region", "top").alias("top_region_sessions"),
        of("category", "winner").alias("top_category"),
        of("category", "top").alias("top_category_clicks"),
        of("colour", "winner").alias("top_colour"),
        of("colour", "top").alias("top_colour_clicks"),
    )

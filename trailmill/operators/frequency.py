"""Item frequencies, rank-frequency fit and session-length distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.scale import running_totals
from trailmill.schema import ITEM, SESSION


def ranked_frequencies(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    """Clicks per item with its frequency rank and the running click count."""
    counts = clicks.groupBy(item).agg(F.count(F.lit(1)).alias("clicks"))
    return running_totals(
        counts, [F.desc("clicks"), F.asc(item)], {"rank": F.lit(1).cast("long"), "clicks_upto": "clicks"}
    )


def zipf_fit(ranked: DataFrame, shift: float = 10, ignore_top: int = 0, ignore_bottom: int = 0) -> DataFrame:
    """Least-squares line of log clicks on log(rank + shift), as one row.

    ``c`` and ``alpha`` give the density c / (rank + shift) ^ alpha. Ranks are those
    of the full list; the ignored ends only leave the fit.
    """
    kept = ranked.filter(F.col("rank") > ignore_top)
    if ignore_bottom:
        kept = kept.filter(F.col("rank") <= ranked.count() - ignore_bottom)
    logs = kept.select(F.ln(F.col("rank") + F.lit(shift)).alias("x"), F.ln("clicks").alias("y"))
    moments = logs.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
        F.var_pop("x").alias("var_x"),
        F.var_pop("y").alias("var_y"),
        F.count(F.lit(1)).alias("items"),
    )
    explained = F.pow("slope", F.lit(2)) * F.col("var_x")
    return moments.select(
        F.exp("intercept").alias("c"),
        (-F.col("slope")).alias("alpha"),
        "r2",
        (F.col("var_y") - explained).alias("mse"),
        explained.alias("explained_variance"),
        "items",
    )


def zipf_curve(ranked: DataFrame, fit: DataFrame, shift: float = 10) -> DataFrame:
    """Fitted log clicks, residual and density of every item."""
    c, alpha = fit.select("c", "alpha").first()
    x = F.ln(F.col("rank") + F.lit(shift))
    return ranked.withColumn("estimate", F.ln(F.lit(c)) - F.lit(alpha) * x).withColumns(
        {
            "residual": F.ln("clicks") - F.col("estimate"),
            "density": F.lit(c) / F.pow(F.col("rank") + F.lit(shift), F.lit(alpha)),
        }
    )


def mass_items(ranked: DataFrame, mass: float = 0.5) -> DataFrame:
    """How many of the most clicked items stay within a share of all clicks."""
    total = ranked.agg(F.sum("clicks")).first()[0]
    within = F.col("clicks_upto").cast("double") / F.lit(total) <= mass
    return ranked.agg(F.count_if(within).alias("items"), F.lit(total).cast("long").alias("clicks"))


def top_bottom(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The n most and the n least clicked items."""
    size = ranked.count()
    end = F.when(F.col("rank") <= n, "top").when(F.col("rank") > size - n, "bottom")
    return ranked.withColumn("end", end).filter(F.col("end").isNotNull())


def length_distribution(clicks: DataFrame) -> DataFrame:
    """Sessions per length with probability and cumulative probability."""
    lengths = clicks.groupBy(SESSION).agg(F.count(F.lit(1)).alias("length"))
    counts = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("sessions"))
    upto = running_totals(counts, ["length"], {"sessions_upto": "sessions"})
    total = upto.agg(F.max("sessions_upto")).first()[0]
    return upto.select(
        "length",
        "sessions",
        (F.col("sessions").cast("double") / F.lit(total)).alias("probability"),
        (F.col("sessions_upto").cast("double") / F.lit(total)).alias("cumulative"),
    )

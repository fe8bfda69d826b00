"""Train and test splits of sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.scale import bounded_side
from trailmill.schema import ORDER, SESSION


def hash_fraction(key: str | Column, seed: int) -> Column:
    """Uniform value in [0, 1) from a key and a seed, the same on every run."""
    column = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws(":", F.lit(seed), column.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def stratified_split(
    clicks: DataFrame, train: float = 0.8, seed: int = 42, per_length: dict[int, float] | None = None
) -> DataFrame:
    """Add ``in_train``: an independent draw per session with the fraction of its stratum.

    Strata are session lengths. With one fraction for all of them the draw needs the
    session id only, so no length is counted and nothing is shuffled.
    """
    draw = hash_fraction(SESSION, seed)
    if per_length is None:
        return clicks.withColumn("in_train", draw < train)
    lengths = bounded_side(clicks.groupBy(SESSION).agg(F.count(F.lit(1)).alias("_length")))
    entries = [F.lit(x) for pair in per_length.items() for x in pair]
    fraction = F.coalesce(F.try_element_at(F.create_map(*entries), F.col("_length").cast("int")), F.lit(train))
    return clicks.join(lengths, SESSION).withColumn("in_train", draw < fraction).drop("_length")


def temporal_split(clicks: DataFrame, cutoff: str, date: str = "click_date") -> DataFrame:
    """Add ``in_train``: the session's first date lies before the cutoff."""
    firsts = clicks.groupBy(SESSION).agg((F.min(date) < F.lit(cutoff).cast("date")).alias("in_train"))
    return clicks.join(bounded_side(firsts), SESSION)


def leave_last_out(clicks: DataFrame) -> DataFrame:
    """Add ``is_truth``: true on the last click of a session, false on its context.

    The order alone decides, so null items and gaps in the order do not matter.
    """
    lasts = clicks.groupBy(F.col(SESSION).alias("_session")).agg(F.max(ORDER).alias("_last"))
    joined = clicks.join(lasts, F.col(SESSION).eqNullSafe(F.col("_session")))
    return joined.withColumn("is_truth", F.col(ORDER) == F.col("_last")).drop("_session", "_last")


def ground_truth(held_out: DataFrame, min_context: int = 1) -> DataFrame:
    """Last clicks of the sessions with enough clicks before them."""
    return (
        held_out.filter(F.col("is_truth") & (F.col(ORDER) > min_context))
        .withColumn("n_context", F.col(ORDER) - 1)
        .withColumn("is_cold", F.col("n_context") == 1)
        .drop("is_truth")
    )


def context(held_out: DataFrame) -> DataFrame:
    return held_out.filter(~F.col("is_truth")).drop("is_truth")


def sample_by_group(df: DataFrame, group: str, fraction: float, key: str = SESSION, seed: int = 42) -> DataFrame:
    """The same fraction of every group, drawn per key."""
    draw = hash_fraction(F.concat_ws("/", F.col(group).cast("string"), F.col(key).cast("string")), seed)
    return df.filter(draw < fraction)

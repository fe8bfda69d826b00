"""Click tokens, ordered sequences, prefixes and transitions.

``click_order`` is expected to count a session's clicks 1, 2, 3, ... as the raw log
does; ``scale.dense_position`` builds such a column where it is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.scale import SPAN, bounded_side, materialise, span_of, with_next
from trailmill.schema import ITEM, ORDER, SESSION

# Control characters, which attribute values do not contain.
SEPARATOR = "\x1f"
NULL_TEXT = "\x00"


def token_id(attributes: Sequence[str]) -> Column:
    """Token id from the attribute values themselves.

    The same attributes give the same id in every run and every data set, so
    tokenising needs neither a shuffle nor a join.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in attributes]
    return F.md5(F.concat_ws(SEPARATOR, *values))


def tokens(clicks: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return clicks.select(*attributes).distinct().withColumn("token", token_id(attributes))


def tokenise(
    clicks: DataFrame, attributes: Sequence[str], known: DataFrame | None = None
) -> DataFrame:
    """Add the token id; with ``known`` tokens, a click outside them gets a null id."""
    out = clicks.withColumn("token", token_id(attributes))
    if known is None:
        return out
    vocabulary = bounded_side(known.select("token").distinct().withColumn("_known", F.lit(True)))
    return (
        out.join(vocabulary, "token", "left")
        .withColumn("token", F.when(F.col("_known"), F.col("token")))
        .drop("_known")
    )


def next_click(clicks: DataFrame, item: str = ITEM, ahead: int = 1) -> DataFrame:
    """Item ``ahead`` clicks later in the session, null at its end."""
    return with_next(clicks, [SESSION], ORDER, {"next": item}, ahead)


def collapse_repeats(clicks: DataFrame, item: str = ITEM, keep_last_run: bool = True) -> DataFrame:
    """Keep the last click of each run of the same item.

    ``keep_last_run=False`` also drops the run a session ends with.
    """
    moved = F.col("next") != F.col(item)
    keep = F.coalesce(moved, F.lit(keep_last_run))
    return next_click(clicks, item).filter(keep).drop("next")


def session_sequences(clicks: DataFrame, item: str = ITEM, span: int = SPAN) -> DataFrame:
    """Ordered items per session as (session, segment, sequence).

    A session longer than ``span`` clicks continues in further segments, so an
    array never outgrows a row.
    """
    pair = F.struct(F.col(ORDER), F.col(item).alias("item"))
    return (
        clicks.groupBy(SESSION, span_of(ORDER, span).alias("segment"))
        .agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
        .select(SESSION, "segment", F.col("pairs.item").alias("sequence"))
    )


def prefix_sequences(clicks: DataFrame, item: str = ITEM, ahead: int = 1, span: int = SPAN) -> DataFrame:
    """One row per click that has a click ``ahead`` of it: the items so far and that item.

    A prefix that reaches over several segments of a session comes as one row per
    segment. The output grows with the square of the session length by definition;
    ``pooling.prefix_pool`` gives the pooled vectors without building prefixes.
    """
    segments = session_sequences(clicks, item, span).withColumnRenamed("segment", "part")
    points = next_click(clicks, item, ahead).filter(F.col("next").isNotNull())
    points = points.select(SESSION, ORDER, "next", span_of(ORDER, span).alias("segment"))
    reach = points.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "segment")))
    taken = F.when(
        F.col("part") == F.col("segment"),
        F.slice("sequence", 1, (F.pmod(F.col(ORDER) - 1, F.lit(span)) + 1).cast("int")),
    ).otherwise(F.col("sequence"))
    return reach.join(segments, [SESSION, "part"]).select(
        SESSION, ORDER, F.col("part").alias("segment"), taken.alias("prefix"), "next"
    )


def transition_counts(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    return (
        next_click(clicks, item)
        .filter(F.col("next").isNotNull())
        .groupBy(F.col(item).alias("src"), F.col("next").alias("dst"))
        .agg(F.count(F.lit(1)).alias("moves"))
    )


def transitions(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    """First-order transition weights; moves to the same item count in the total only."""
    counts = materialise(transition_counts(clicks, item))
    totals = bounded_side(counts.groupBy("src").agg(F.sum("moves").alias("total")))
    return (
        counts.join(totals, "src")
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst", "moves", (F.col("moves").cast("double") / F.col("total")).alias("weight"))
    )

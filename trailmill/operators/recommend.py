"""Item index, interactions, and recommenders built from counts and similarities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmill.operators.cooccurrence import pair_sums
from trailmill.operators.sequences import transitions
from trailmill.scale import bounded_side, dense_position, materialise, running_totals, span_of
from trailmill.schema import ITEM, ORDER, SESSION

TOP_K = 10
NEIGHBOURS = 50
SCORE_DIGITS = 9


def item_index(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    """Dense item numbers from 0, the most clicked item first, ties by name."""
    counts = clicks.groupBy(item).agg(F.count(F.lit(1)).alias("clicks"))
    ranked = running_totals(counts, [F.desc("clicks"), F.asc(item)], {"_rank": F.lit(1)})
    return ranked.select(item, (F.col("_rank") - 1).cast("int").alias("item_idx"))


def interactions(clicks: DataFrame, index: DataFrame, item: str = ITEM) -> DataFrame:
    """Clicks per (session, item), counted before the item number is joined."""
    counts = clicks.groupBy(SESSION, item).agg(F.count(F.lit(1)).alias("click_count"))
    return counts.join(bounded_side(index), item).select(SESSION, "item_idx", "click_count")


def exclude_seen(scores: DataFrame, seen: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top k unseen items per session.

    Scores are rounded before they are ranked, so that the order of additions
    cannot swap two items; equal scores are ranked by item number.
    """
    w = Window.partitionBy(SESSION).orderBy(F.desc("score"), F.asc("item_idx"))
    fresh = scores.withColumn("score", F.round("score", SCORE_DIGITS)).join(
        seen.select(SESSION, "item_idx").distinct(), [SESSION, "item_idx"], "left_anti"
    )
    return (
        fresh.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(SESSION, "item_idx", "score", "rank")
    )


def top_unseen(contexts: DataFrame, lists: DataFrame, seen: DataFrame, k: int = TOP_K) -> DataFrame:
    """First k items of a ranked list that a session has not seen.

    ``contexts`` is (session, list), ``lists`` is (list, item_idx, score, position)
    with positions 1, 2, 3, ... in each list. If the j-th seen item of a session sits
    at position p, then p - j unseen items come before it. The u-th unseen item is
    therefore at u plus the number of seen items with p - j < u: each session needs k
    counters and k look-ups, however long the lists are.
    """
    ranked = bounded_side(lists)
    named = bounded_side(contexts.select(SESSION, "list"))
    met = (
        seen.select(SESSION, "item_idx").distinct()
        .join(named, SESSION)
        .join(ranked.select("list", "item_idx", "position"), ["list", "item_idx"])
        .select(SESSION, "position")
    )
    placed = dense_position(met, [SESSION], ["position"], span_of("position"), out="_j")
    before = F.col("position") - F.col("_j")
    blocked = placed.filter(before < k).groupBy(SESSION).agg(
        F.array(*[F.count_if(before < u) for u in range(1, k + 1)]).alias("_skip")
    )
    wanted = (
        named.join(blocked, SESSION, "left")
        .select(SESSION, "list", "_skip", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
        .withColumn("position", F.col("rank") + F.coalesce(F.get("_skip", F.col("rank") - 1), F.lit(0)))
    )
    return wanted.join(ranked, ["list", "position"]).select(
        SESSION, "item_idx", F.col("score").cast("double").alias("score"), "rank"
    )


def popularity_list(train: DataFrame) -> DataFrame:
    """All items as one list, the most clicked first."""
    counts = train.groupBy("item_idx").agg(F.sum("click_count").alias("score"))
    ranked = running_totals(counts, [F.desc("score"), F.asc("item_idx")], {"position": F.lit(1).cast("long")})
    return ranked.withColumn("list", F.lit(0))


def popularity_recs(sessions: DataFrame, train: DataFrame, seen: DataFrame, k: int = TOP_K) -> DataFrame:
    contexts = sessions.select(SESSION).distinct().withColumn("list", F.lit(0))
    return top_unseen(contexts, popularity_list(train), seen, k)


def item_similarity(train: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Cosine similarity of item columns, the nearest items of each item.

    Dot products and squared norms are whole numbers, so similarities do not depend
    on the order of additions.
    """
    norms = bounded_side(
        train.groupBy("item_idx").agg(F.sum(F.col("click_count") * F.col("click_count")).alias("norm2"))
    )
    dots = pair_sums(train, "item_idx", "click_count")
    left = norms.select(F.col("item_idx").alias("item_a"), F.col("norm2").alias("norm2_a"))
    right = norms.select(F.col("item_idx").alias("item_b"), F.col("norm2").alias("norm2_b"))
    length = F.sqrt(F.col("norm2_a").cast("double") * F.col("norm2_b").cast("double"))
    similar = (
        dots.join(left, "item_a")
        .join(right, "item_b")
        .withColumn("similarity", F.col("total").cast("double") / length)
    )
    ends = F.array(
        F.struct(F.col("item_a").alias("seed_idx"), F.col("item_b").alias("target_idx")),
        F.struct(F.col("item_b").alias("seed_idx"), F.col("item_a").alias("target_idx")),
    )
    w = Window.partitionBy("seed_idx").orderBy(F.desc("similarity"), F.asc("target_idx"))
    return (
        similar.filter(F.col("similarity") > 0)
        .select("similarity", F.inline(ends))
        .withColumn("neighbour_rank", F.row_number().over(w))
        .filter(F.col("neighbour_rank") <= neighbours)
        .select("seed_idx", "target_idx", "similarity", "neighbour_rank")
    )


def knn_recs(history: DataFrame, similarity: DataFrame, seen: DataFrame, k: int = TOP_K) -> DataFrame:
    """Sum of click count times similarity over the session's items, minus seen items."""
    near = bounded_side(similarity.select(F.col("seed_idx").alias("item_idx"), "target_idx", "similarity"))
    scores = (
        history.join(near, "item_idx")
        .groupBy(SESSION, F.col("target_idx").alias("item_idx"))
        .agg(F.sum(F.col("click_count") * F.col("similarity")).alias("score"))
    )
    return exclude_seen(scores, seen, k)


def last_items(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    return clicks.groupBy(SESSION).agg(F.max_by(item, ORDER).alias(item))


def markov_recs(
    context: DataFrame, train_clicks: DataFrame, index: DataFrame, k: int = TOP_K, item: str = ITEM
) -> DataFrame:
    """Next items by transition weight of the last click, minus seen items."""
    names = bounded_side(index)
    steps = (
        transitions(train_clicks, item)
        .join(names.select(F.col(item).alias("src"), F.col("item_idx").alias("list")), "src")
        .join(names.select(F.col(item).alias("dst"), "item_idx"), "dst")
        .select("list", "item_idx", F.col("weight").alias("score"))
    )
    lists = running_totals(
        steps, [F.desc("score"), F.asc("item_idx")], {"position": F.lit(1).cast("long")}, ["list"]
    )
    last = last_items(context, item).join(names, item).select(SESSION, F.col("item_idx").alias("list"))
    seen = context.select(SESSION, item).distinct().join(names, item).select(SESSION, "item_idx")
    return top_unseen(last, materialise(lists), seen, k)

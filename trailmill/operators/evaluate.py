"""Ranking quality, coverage, novelty and model comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmill.scale import bounded_side, materialise
from trailmill.schema import ORDER, SESSION


#: (track, model) to the condition on rows of lists and the condition on true items that make up this cell.
Cells = Mapping[tuple[str, str], tuple[Column, Column]]


def session_hits(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """Per session: relevant items, hits, and the rank of the first hit.

    A session without recommendations keeps its row, with no hits.
    """
    best = (
        recs.filter(F.col("rank") <= k)
        .groupBy(SESSION, "item_idx")
        .agg(F.min("rank").alias("rank"))
    )
    return (
        truth.select(SESSION, "item_idx")
        .join(best, [SESSION, "item_idx"], "left")
        .groupBy(SESSION)
        .agg(
            F.count(F.lit(1)).alias("n_relevant"),
            F.count("rank").alias("n_hits"),
            F.min("rank").alias("first_hit_rank"),
        )
    )


def rank_metrics(recs: DataFrame, truth: DataFrame, k: int = 10, cells: Cells | None = None) -> DataFrame:
    """MRR, precision and recall at k in one row; precision divides by k.

    With ``cells``, ``recs`` holds the lists of several models, and there is one row per track and model, from one pass over all of them.
    """
    if cells is not None:
        return cell_ranks(recs, truth, k, cells)
    hits = session_hits(recs, truth, k)
    return hits.agg(
        F.avg(F.coalesce(1.0 / F.col("first_hit_rank"), F.lit(0.0))).alias("mrr"),
        F.avg(F.col("n_hits") / F.lit(k)).alias("precision"),
        F.avg(F.col("n_hits") / F.col("n_relevant")).alias("recall"),
        F.count(F.lit(1)).alias("sessions"),
    )


def cell_ranks(recs: DataFrame, truth: DataFrame, k: int, cells: Cells) -> DataFrame:
    """``rank_metrics`` of every cell: one exchange of the lists, one row per session for all cells.

    A session without true items in a cell does not count there.
    """
    listed, true = [c for c, _ in cells.values()], [c for _, c in cells.values()]
    top = recs.filter(F.col("rank") <= k)
    best = top.groupBy(SESSION, "item_idx").agg(*[F.min(F.when(c, F.col("rank"))).alias(f"_rank{i}") for i, c in enumerate(listed)])
    items = truth.select(SESSION, "item_idx", *[c.alias(f"_in{i}") for i, c in enumerate(true)])
    per_session, out = [], []
    for i, (track, model) in enumerate(cells):
        rank = F.when(F.col(f"_in{i}"), F.col(f"_rank{i}"))
        per_session += [
            F.count_if(f"_in{i}").alias(f"_relevant{i}"), F.count(rank).alias(f"_hits{i}"), F.min(rank).alias(f"_first{i}")
        ]
        counts, hits = F.col(f"_relevant{i}") > 0, F.col(f"_hits{i}")
        measures = {
            "mrr": F.avg(F.when(counts, F.coalesce(1.0 / F.col(f"_first{i}"), F.lit(0.0)))),
            "precision": F.avg(F.when(counts, hits / F.lit(k))),
            "recall": F.avg(F.try_divide(hits, F.col(f"_relevant{i}"))),
            "sessions": F.count_if(counts),
        }
        out.append(cell_struct(track, model, measures))
    sessions = items.join(best, [SESSION, "item_idx"], "left").groupBy(SESSION).agg(*per_session)
    return sessions.agg(F.array(*out).alias("cells")).select(F.inline("cells"))


def cell_struct(track: str, model: str, measures: dict[str, Column]) -> Column:
    return F.struct(F.lit(track).alias("track"), F.lit(model).alias("model"), *[c.alias(name) for name, c in measures.items()])


def coverage_novelty(
    recs: DataFrame, train: DataFrame, catalogue: int, k: int = 10, cells: Mapping[tuple[str, str], Column] | None = None
) -> DataFrame:
    """Share of the catalogue that is recommended and mean self-information of list entries.

    Recommended items are counted before item popularity is joined. Items without
    training clicks count for coverage and not for novelty. With ``cells``, conditions on the rows of ``recs``, there is one row
    per track and model, from one pass over the lists of all models.
    """
    popularity = train.groupBy("item_idx").agg(F.sum("click_count").alias("clicks"))
    if cells is not None:
        return cell_coverage(recs, materialise(popularity), catalogue, k, cells)
    total = popularity.agg(F.sum("clicks")).first()[0]
    shown = recs.groupBy("item_idx").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rank") <= k).alias("n_top")
    )
    bits = -F.log2(F.col("clicks").cast("double") / F.lit(total))
    joined = shown.join(bounded_side(popularity), "item_idx", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("unique_items"),
        (F.count(F.lit(1)) / F.lit(catalogue)).alias("coverage"),
        F.try_divide(
            F.sum(F.col("n_top") * bits), F.sum(F.when(F.col("clicks").isNotNull(), F.col("n_top")))
        ).alias("novelty"),
    )


def cell_coverage(
    recs: DataFrame, popularity: DataFrame, catalogue: int, k: int, cells: Mapping[tuple[str, str], Column]
) -> DataFrame:
    """``coverage_novelty`` of every cell; items are counted for all cells at once."""
    total = popularity.agg(F.sum("clicks")).first()[0]
    counts = []
    for i, inside in enumerate(cells.values()):
        counts += [F.count_if(inside).alias(f"_n{i}"), F.count_if(inside & (F.col("rank") <= k)).alias(f"_top{i}")]
    shown = recs.groupBy("item_idx").agg(*counts).join(bounded_side(popularity), "item_idx", "left")
    bits = -F.log2(F.col("clicks").cast("double") / F.lit(total))
    out = []
    for i, (track, model) in enumerate(cells):
        items, top = F.count_if(F.col(f"_n{i}") > 0), F.col(f"_top{i}")
        known = F.when((F.col(f"_n{i}") > 0) & F.col("clicks").isNotNull(), top)
        measures = {
            "unique_items": items,
            "coverage": items / F.lit(catalogue),
            "novelty": F.try_divide(F.sum(known * bits), F.sum(known)),
        }
        out.append(cell_struct(track, model, measures))
    return shown.agg(F.array(*out).alias("cells")).select(F.inline("cells"))


def prefix_metrics(recs: DataFrame, n: int = 10) -> DataFrame:
    """Recall and NDCG per prefix; ``recs`` carries the held-out ``next`` on every row.

    Prefixes without recommendations are not in ``recs`` and are not counted.
    """
    hit = (F.col("item_idx") == F.col("next")) & (F.col("rank") <= n)
    gain = F.when(hit, 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)
    per_prefix = recs.groupBy(SESSION, ORDER, "next").agg(
        F.max(hit.cast("int")).alias("hit"), F.max(gain).alias("ndcg")
    )
    return per_prefix.agg(
        F.avg("hit").alias("recall"), F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("prefixes")
    )


def next_rank_metrics(ranks: DataFrame, n: int = 10) -> DataFrame:
    """Recall and NDCG over all prefixes from the rank of the next item, null where it could not be ranked.

    Both are sums of whole numbers of prefixes per rank, so they do not depend on the order of additions.
    """
    counts = ranks.groupBy(F.when(F.col("rank") <= n, F.col("rank")).alias("rank")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    gain = F.when(F.col("rank").isNotNull(), F.col("n") / F.log2(F.col("rank") + 1.0))
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("rank").isNotNull(), F.col("n"))) / total, F.lit(0.0)).alias("recall"),
        F.coalesce(F.sum(gain) / total, F.lit(0.0)).alias("ndcg"),
        F.coalesce(total, F.lit(0)).alias("prefixes"),
    )


def long_metrics(track: str | Column, model: str | Column, row: DataFrame) -> DataFrame:
    """One-row metric frame as (track, model, metric, value) rows; ``track`` and ``model`` may be columns of a frame with several rows."""
    measures = [c for c in row.columns if c not in ("track", "model")]
    entries = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in measures]
    )
    return row.select(F.lit(track).alias("track"), F.lit(model).alias("model"), F.inline(entries))


def compare_models(metrics: DataFrame, baseline: str = "popularity") -> DataFrame:
    """Difference to the baseline, relative change (null at a zero baseline), and the best model."""
    w = Window.partitionBy("track", "metric")  # one row per model
    base = F.max(F.when(F.col("model") == baseline, F.col("value"))).over(w)
    best = F.max_by("model", F.struct("value", "model")).over(w)
    change = F.when(base != 0, (F.col("value") - base) / F.when(base != 0, base))
    return metrics.withColumns(
        {"delta": F.col("value") - base, "change": change, "is_best": F.col("model") == best}
    )


def most_viewed(train: DataFrame, labels: DataFrame, n: int = 10) -> DataFrame:
    """The n most clicked training items with their labels."""
    top = (
        train.groupBy("item_idx")
        .agg(F.sum("click_count").alias("clicks"))
        .orderBy(F.desc("clicks"), "item_idx")
        .limit(n)
    )
    return labels.join(F.broadcast(top), "item_idx")  # n rows

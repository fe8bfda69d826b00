"""Click graph: edges, pruning, ranks, components, motifs and communities."""

from __future__ import annotations

from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmill.functions.aggregates import smallest_mode
from trailmill.operators.sequences import transition_counts
from trailmill.scale import (
    bounded_side,
    counted,
    exact_percentiles,
    has_at_most,
    hinted,
    is_small,
    materialise,
    watched,
)
from trailmill.schema import ITEM, ORDER, SESSION


def click_edges(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    """Directed edges between consecutive clicks; the weight counts them, self moves included."""
    return transition_counts(clicks, item).withColumnRenamed("moves", "weight")


def click_vertices(clicks: DataFrame, item: str = ITEM, attributes: tuple[str, ...] = ()) -> DataFrame:
    return clicks.select(F.col(item).alias("id"), *attributes).distinct()


def prune(edges: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Edges at or above the weight quantile, log weights, self moves dropped at the end."""
    kept = materialise(edges)
    limit = exact_percentiles(kept, "weight", {"q": quantile}).first()["q"]
    return (
        kept.filter(F.col("weight") >= F.lit(limit))
        .withColumn("weight", F.ln("weight"))
        .filter(F.col("src") != F.col("dst"))
    )


def both_ends(edges: DataFrame) -> DataFrame:
    """Every edge once from each end, as (id, other) rows."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("other")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("other")),
    )
    return edges.select(F.inline(ends))


def connected_vertices(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices that touch an edge."""
    return vertices.join(both_ends(edges).select("id").distinct(), "id", "left_semi")


class Links:
    """Directed links placed once for a loop that joins a value per vertex to them again and again.

    Values of few vertices are sent to the links. Otherwise links are exchanged once, by their ``src``, and stay there: the
    values arrive by the same key, so a round moves values only. Sources with a large part of the
    links stay spread out, and the values of these few are sent.
    """

    def __init__(self, links: DataFrame, size: int):
        self.small = is_small(size)
        self.kept: list[DataFrame] = []
        self.parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if self.small:
            self.spread, self.placed = materialise(links), None
            return
        links = materialise(links)
        limit = max(1, links.count() // (4 * self.parts))
        hubs = links.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("src")
        self.hubs = F.broadcast(materialise(hubs))  # fewer than four per partition
        self.spread = materialise(links.join(self.hubs, "src", "left_semi"))
        self.placed = self.keep(links.join(self.hubs, "src", "left_anti"), "src")

    def by_id(self, values: DataFrame) -> DataFrame:
        """``values`` placed by ``id`` like the links by ``src``."""
        if self.small:
            return values
        return self.keep(values, "id")

    def keep(self, frame: DataFrame, key: str) -> DataFrame:
        placed = frame.repartition(self.parts, key).persist()
        placed.count()  # only a finished plan tells joins how it is partitioned
        self.kept.append(placed)
        return placed

    def close(self) -> None:
        """Give the kept partitions back; what was lost with an executor meanwhile is made again from the written links."""
        for frame in self.kept:
            frame.unpersist()

    def joined(self, values: DataFrame) -> DataFrame:
        """Links with the value of their source; ``values`` has ``id``."""
        renamed = values.withColumnRenamed("id", "src")
        if self.small:
            return self.spread.join(F.broadcast(renamed), "src")
        few = F.broadcast(renamed.join(self.hubs, "src", "left_semi"))
        return self.placed.join(renamed, "src").unionByName(self.spread.join(few, "src"))


def pagerank(
    vertices: DataFrame, edges: DataFrame, rounds: int = 100, reset: float = 0.15, every: int = 10
) -> DataFrame:
    """Rank = reset + (1 - reset) * sum of source ranks over their out-degrees.

    All vertices start at 1. Where vertices without out-edges leak rank, the result
    is scaled so that ranks add up to the number of vertices. Few ranks are written every few rounds, many every round.
    """
    plain = materialise(edges.select("src", "dst"))
    degrees = plain.groupBy("src").agg((1.0 / F.count(F.lit(1))).alias("share"))
    ids, size = counted(vertices.select("id").distinct())
    links = Links(plain.join(hinted(degrees, is_small(size)), "src"), size)
    ids = links.by_id(ids)
    ranks = ids.withColumn("rank", F.lit(1.0))
    for number in range(1, rounds + 1):
        gained = links.joined(ranks).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("gain"))
        ranks = ids.join(gained, "id", "left").select(
            "id", (F.lit(reset) + (1 - reset) * F.coalesce("gain", F.lit(0.0))).alias("rank")
        )
        if number % every == 0 or number == rounds or not links.small:  # a large frame is read twice in a round
            ranks = materialise(ranks)
    links.close()
    leaks = ids.join(plain.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
    if not has_at_most(leaks, 0):
        total = ranks.agg(F.sum("rank")).first()[0]
        ranks = ranks.withColumn("rank", F.col("rank") * F.lit(size / total))
    return ranks


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components, direction ignored; a component is named by its smallest vertex.

    Each round takes the smallest label among the neighbours and then follows that
    label one step, which shortens long chains quickly. Stops when nothing changes.
    """
    links = materialise(both_ends(edges).filter(F.col("id") != F.col("other")).distinct())
    labels, size = counted(vertices.select("id", F.col("id").alias("component")).distinct())
    small = is_small(size)
    while True:
        near = (
            links.join(hinted(labels, small).withColumnRenamed("id", "other"), "other")
            .groupBy("id")
            .agg(F.min("component").alias("near"))
        )
        lower = materialise(
            labels.join(near, "id", "left").select(
                "id", "component", F.least("component", "near").alias("lower")
            )
        )
        jump = hinted(lower, small).select(F.col("id").alias("lower"), F.col("lower").alias("root"))
        changed = F.count_if(F.col("old") != F.col("component"))
        moved, changes = watched(
            lower.join(jump, "lower", "left").select(
                "id", F.col("component").alias("old"), F.least("lower", "root").alias("component")
            ),
            changed,
        )
        labels = moved.select("id", "component")
        if changes == 0:
            return labels


def triangles(edges: DataFrame) -> DataFrame:
    """Directed cycles a -> b -> c -> a, one row per rotation.

    A cycle is found once, at its vertex of lowest degree. Seen from there both
    neighbours have at least that degree, so the two-step paths tried are few even
    around a vertex that has a large share of all edges.
    """
    links = materialise(edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct())
    degree = materialise(both_ends(links).groupBy("id").agg(F.count(F.lit(1)).alias("n")))

    def ranked(name: str) -> DataFrame:
        return bounded_side(degree.select(F.col("id").alias(name), F.struct("n", "id").alias(f"{name}_rank")))

    ordered = materialise(links.join(ranked("src"), "src").join(ranked("dst"), "dst"))
    out = ordered.filter(F.col("src_rank") < F.col("dst_rank"))
    into = ordered.filter(F.col("dst_rank") < F.col("src_rank"))
    steps = out.select(F.col("src").alias("a"), F.col("dst").alias("b")).join(
        into.select(F.col("dst").alias("a"), F.col("src").alias("c")), "a"
    )
    closed = steps.join(
        links.select(F.col("src").alias("b"), F.col("dst").alias("c")), ["b", "c"], "left_semi"
    )
    turns = [("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")]
    rotations = F.array(
        *[F.struct(*[F.col(v).alias(n) for n, v in zip(("a", "b", "c"), turn)]) for turn in turns]
    )
    return closed.select(F.inline(rotations))


def label_propagation(vertices: DataFrame, edges: DataFrame, rounds: int = 10) -> DataFrame:
    """Every vertex takes the most frequent label around it; the smallest one on ties.

    From the second round on only vertices next to one that changed vote again. Stops when nothing changes.
    """
    plain = materialise(both_ends(edges))
    labels, size = counted(vertices.select("id", F.col("id").alias("label")).distinct())
    links = Links(plain.select(F.col("other").alias("src"), F.col("id").alias("dst")), size)
    labels = links.by_id(labels)
    moved = None
    for _ in range(rounds):
        ballots = links.joined(labels)
        if moved is not None:
            near = links.joined(moved.select("id")).select("dst").distinct()
            ballots = ballots.join(hinted(near, links.small), "dst", "left_semi")
        votes = (
            ballots.groupBy("dst", "label").agg(F.count(F.lit(1)).alias("votes"))
            .groupBy(F.col("dst").alias("id")).agg(smallest_mode("label", "votes").alias("voted"))
        )
        fresh = labels.join(votes, "id", "left").select(
            "id", F.coalesce("voted", "label").alias("label"), (F.col("voted") != F.col("label")).alias("moved")
        )
        written, changes = watched(fresh, F.count_if("moved"))
        labels, moved = written.select("id", "label"), written.filter("moved")
        if changes == 0:
            break
    links.close()
    return labels if rounds else materialise(labels)


def power_iteration(edges: DataFrame, k: int = 10, rounds: int = 50) -> DataFrame:
    """Power iteration clusters of the undirected graph; ids must be numbers."""
    pairs = (
        edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.sum("weight").alias("weight"))
        .filter(F.col("weight") > 0)
    )
    model = PowerIterationClustering(k=k, maxIter=rounds, weightCol="weight", initMode="random")
    return model.assignClusters(pairs)


def path_counts(edges: DataFrame) -> DataFrame:
    """How many three-edge paths end with each edge, without listing the paths."""
    links = materialise(edges.select("src", "dst", "weight"))
    ways = links.groupBy(F.col("dst").alias("src")).agg(F.count(F.lit(1)).alias("ways"))
    two = (
        links.join(bounded_side(ways), "src")
        .groupBy(F.col("dst").alias("src"))
        .agg(F.sum("ways").alias("paths"))
    )
    return links.join(bounded_side(two), "src").select("src", "dst", "weight", "paths")


def last_clicks(clicks: DataFrame, item: str = ITEM, n: int = 3) -> DataFrame:
    """The last n items of each session as columns n1 (oldest) to n{n}; shorter sessions drop out."""
    ends = clicks.groupBy(SESSION).agg(F.max(ORDER).alias("_last"))
    tail = clicks.join(bounded_side(ends), SESSION).filter(F.col(ORDER) > F.col("_last") - n)
    place = F.col(ORDER) - F.col("_last") + n
    return (
        tail.groupBy(SESSION)
        .agg(*[F.max(F.when(place == i, F.col(item))).alias(f"n{i}") for i in range(1, n + 1)])
        .filter(F.col("n1").isNotNull())
    )


def path_recommendations(contexts: DataFrame, edges: DataFrame, k: int = 10) -> DataFrame:
    """Next items for sessions whose last three items form a path in the graph.

    The score is the weight of the last edge. Only the k strongest edges out of each
    vertex can be recommended, so each context meets at most k rows.
    """
    links = materialise(edges)
    known = bounded_side(links.select("src", "dst"))
    first = known.select(F.col("src").alias("n1"), F.col("dst").alias("n2"))
    second = known.select(F.col("src").alias("n2"), F.col("dst").alias("n3"))
    strongest = Window.partitionBy("src").orderBy(F.desc("weight"), "dst")
    top = links.withColumn("rank", F.row_number().over(strongest)).filter(F.col("rank") <= k)
    return (
        contexts.join(first, ["n1", "n2"], "left_semi")
        .join(second, ["n2", "n3"], "left_semi")
        .join(
            bounded_side(
                top.select(F.col("src").alias("n3"), F.col("dst").alias("next"), F.col("weight").alias("score"), "rank")
            ),
            "n3",
        )
    )

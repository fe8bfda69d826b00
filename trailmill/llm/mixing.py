"""Mixing sources to target weights by Pareto order sampling.

Sources get weights; their targets share the words of the corpus by weight, stop at ``most`` times
the words of the source, and the excess is shared again by weight among the others. A source whose
target is r times its size takes floor(r) certain copies of each document. What remains is sampled: a document
draws a uniform u from a hash and is ranked by its random odds u / (1 - u) divided by its inclusion odds, which
grow with the square root of its size; the sample is the start of that order up to the remaining words.
One closing document, whose size is nearest to the words still missing, is added if that brings the source nearer.

The order is cut into buckets; words are summed per (source, bucket), and only the bucket in which
a source reaches its target is sorted, so a source with a third of all rows never meets in one task.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, last in order;
a null id draws by its text; rows of a source that repeat id and text are numbered, and each number draws for itself, so
any part of them can be taken; ties in rank go by the draw; an empty table gives no rows; texts of any length are only
counted; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmill.llm.storage import stored
from trailmill.llm.tables import word_count
from trailmill.scale import dense_position, hinted

WEIGHTS = (5, 2, 1)
MOST = 3
BUCKET_ROWS = 5_000
DRAWS = 1 << 52
#: Most repeated draws that are sent to all tasks.
SENT_DRAWS = 100_000


def draw_key(seed: int) -> Column:
    """Hash of seed, id and text as 32 hex digits; the draw is its first 13."""
    return F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary")
    )


def equal_rows(sized: DataFrame) -> DataFrame | None:
    """Source and draw (as one key) that more than one row has; None if there are none."""
    counts = sized.groupBy(equal_key().alias("_equal")).count().where("count > 1").select("_equal")
    found = stored(counts, "equal")
    rows = found.count()
    return hinted(found, rows <= SENT_DRAWS) if rows else None


def equal_key() -> Column:
    return F.concat("draw", F.coalesce(F.concat(F.lit(":"), "source"), F.lit("")))


def numbered(rows: DataFrame, equal: DataFrame | None) -> DataFrame:
    """``rows`` with a draw of its own for each of several equal rows.

    Equal rows are numbered inside the task that reads them, and numbers of earlier tasks are added, so many
    copies of one row never meet in one task. The first keeps its draw.
    """
    if equal is None:
        return rows
    marked = rows.withColumn("_equal", equal_key())
    once = marked.join(equal, "_equal", "left_anti").drop("_equal")
    many = marked.join(equal, "_equal", "left_semi")
    many = dense_position(many, ["_equal"], ["draw"], F.spark_partition_id(), out="_nth")
    own = F.md5(F.concat_ws(":", "draw", (F.col("_nth") - 1).cast("string")).cast("binary"))
    return once.union(many.withColumn("draw", F.when(F.col("_nth") > 1, own).otherwise(F.col("draw"))).select(*rows.columns))


def rank_value() -> Column:
    """Random odds over inclusion odds of a row with draw, size, mean_size and share."""
    u = (F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") + 0.5) / DRAWS
    odds = F.col("share") / (1 - F.col("share")) * F.sqrt(F.col("size") / F.col("mean_size"))
    sampled = (F.col("share") > 0) & (F.col("size") > 0)
    return F.when(sampled, u / (1 - u) / odds)


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source_size, target, whole copies, words left to sample and their share.

    With sources ordered by limit / weight, those before the k-th stop at their limits exactly if the level
    that the others then reach is above each of these; the first k that fits its own limit sets the level.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("filled")
    )
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    limits = per_source.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    spare = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    capped = F.coalesce(F.sum("limit").over(before), F.lit(0))
    levels = limits.withColumn("level", (F.sum("source_size").over(everything) - capped) / spare("weight")).withColumn(
        "place", F.row_number().over(order)
    )
    fits = F.col("limit") / F.col("weight") >= F.col("level")
    level = F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    aimed = levels.withColumn(
        "target", F.least(F.col("limit").cast("double"), F.coalesce(level * F.col("weight"), F.col("limit").cast("double")))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        aimed.withColumn("whole", whole.cast("long"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
        .select(
            "source", "source_size", "target", "whole", "left",
            F.when(F.col("source_size") > 0, F.col("left") / F.col("source_size")).otherwise(0.0).alias("share"),
            F.when(F.col("filled") > 0, F.col("source_size") / F.col("filled")).otherwise(0.0).alias("mean_size"),
        )
    )


def by_source(rows: DataFrame, plan: DataFrame, how: str = "left") -> DataFrame:
    other = plan.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def mix_plan(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Sizes and draws of all rows, and per source what decides how often a row is taken."""
    return planned(docs, weights, most, seed)[:2]


def planned(docs: DataFrame, weights, most: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Both tables of ``mix_plan``, and the keys of rows that are equal."""
    sized = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw_key(seed).alias("draw")), "sizes"
    )
    equal = equal_rows(sized)
    if equal is not None:
        sized = stored(numbered(sized, equal), "sizes")
    aims = stored(targets(sized, weights, most), "targets")
    buckets = max(64, sized.count() // BUCKET_ROWS)
    ranked = by_source(sized, aims).withColumn("rank", rank_value()).where(F.col("rank").isNotNull())
    ranked = stored(
        ranked.select(
            "source", "size", "rank", "draw", "left",
            F.floor(F.col("rank") / (1 + F.col("rank")) * buckets).cast("long").alias("bucket"),
        ),
        "ranks",
    )
    running = Window.partitionBy("source").orderBy("bucket")
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    reached = (
        sums.withColumn("before", F.sum("words").over(running) - F.col("words"))
        .where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
        .select("source", F.col("bucket").alias("cut_bucket"), "before")
    )
    reached = stored(reached, "buckets")
    inside = by_source(ranked, reached, "inner").where(F.col("bucket") == F.col("cut_bucket"))
    order = Window.partitionBy("source").orderBy("rank", "draw").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        inside.withColumn("taken", F.col("before") + F.sum("size").over(order))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("taken") <= F.col("left"), F.struct("rank", "draw"))).alias("last"),
            F.max(F.when(F.col("taken") <= F.col("left"), F.col("taken"))).alias("taken"),
            F.first("before").alias("before"),
            F.first("cut_bucket").alias("cut_bucket"),
        )
        .select(
            "source", "cut_bucket", "last", F.coalesce("taken", "before").alias("sampled")
        )
    )
    cuts = stored(cuts, "cuts")
    missing = F.col("left") - F.col("sampled")
    off = F.abs(F.col("size") - missing)
    open_rows = by_source(ranked, cuts, "inner").where(~sampled_row()).where(off < missing)
    closing = open_rows.groupBy("source").agg(F.min(F.struct(off.alias("off"), "size", "rank", "draw")).alias("closing"))
    plan = by_source(by_source(aims, cuts), closing).withColumn("buckets", F.lit(buckets))
    return sized, stored(plan, "plan"), equal


def sampled_row() -> Column:
    """Whether a ranked row stands before the cut of its source."""
    early = F.col("bucket") < F.col("cut_bucket")
    return early | F.coalesce((F.col("bucket") == F.col("cut_bucket")) & (F.struct("rank", "draw") <= F.col("last")), F.lit(False))


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``copies`` of every row with source, size and draw; source_size and target of its source."""
    ranked = by_source(rows, plan).withColumn("rank", rank_value())
    place = F.floor(F.col("rank") / (1 + F.col("rank")) * F.col("buckets")).cast("long")
    ranked = ranked.withColumn("bucket", place)
    closing = (F.col("rank") == F.col("closing.rank")) & (F.col("draw") == F.col("closing.draw"))
    extra = F.coalesce(sampled_row(), F.lit(False)) | F.coalesce(closing, F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(0)
    return ranked.select(*rows.columns, "source_size", "target", copies.cast("long").alias("copies"))


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """Rows of ``docs``, each as many times as the mix takes it; columns unchanged.

    The plan has one row per source, so the rows of the texts are not moved by a key of theirs.
    """
    _, plan, equal = planned(docs, weights, most, seed)
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), "source", word_count(F.col("text")).alias("size"), draw_key(seed).alias("draw")
    )
    taken = with_copies(numbered(rows, equal), plan).where(F.col("copies") > 0)
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")

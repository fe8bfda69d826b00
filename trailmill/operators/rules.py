"""Association rules between items that share a session, per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.functions.scalars import rule_text
from trailmill.operators.cooccurrence import pair_sums
from trailmill.scale import bounded_side, counted, hinted, is_small, materialise
from trailmill.schema import SESSION


def basket_entries(clicks: DataFrame, item: str, group: str) -> DataFrame:
    """Distinct (group, session, item) rows; clicks without an item are in no basket."""
    return clicks.filter(F.col(item).isNotNull()).select(group, SESSION, item).distinct()


#: Most items that a session's bitmap holds.
BITS = 62


def pair_rules(clicks: DataFrame, item: str, group: str, min_pairs: int = 1) -> DataFrame:
    """Support, confidence both ways and lift of the unordered item pairs per group that ``min_pairs`` sessions hold.

    A session whose items all fit into a bitmap is one number: equal baskets are counted before any pair is made. With
    more items, those in fewer than ``min_pairs`` sessions of a group leave before the pairing, as none of their pairs can
    be frequent.
    """
    entries = materialise(clicks.filter(F.col(item).isNotNull()).select(group, SESSION, item))
    names = [r[0] for r in entries.select(item).distinct().limit(BITS + 1).collect()]
    if len(names) <= BITS:
        pairs, singles, sessions = bitmap_counts(entries, item, group, sorted(names))
    else:
        pairs, singles, sessions = listed_counts(entries, item, group, min_pairs)
    singles, n_singles = counted(singles)

    def side(name: str) -> DataFrame:
        renamed = singles.select(group, F.col(item).alias(f"item_{name}"), F.col("n").alias(f"count_{name}"))
        return hinted(renamed, is_small(n_singles))

    frequent = pairs.filter(F.col("pair_count") >= min_pairs).join(sessions, group)
    return with_ratios(frequent.join(side("a"), [group, "item_a"]).join(side("b"), [group, "item_b"]), group)


def with_ratios(counted_pairs: DataFrame, group: str) -> DataFrame:
    n = F.col("sessions").cast("double")
    both = F.col("pair_count").cast("double")
    return counted_pairs.select(
        group,
        "item_a",
        "item_b",
        "pair_count",
        "sessions",
        "count_a",
        "count_b",
        (both / n).alias("support"),
        (both / F.col("count_a")).alias("confidence_ab"),
        (both / F.col("count_b")).alias("confidence_ba"),
        (both / F.col("count_a") / (F.col("count_b") / n)).alias("lift"),
    )


def bitmap_counts(entries: DataFrame, item: str, group: str, names: list) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs, singles and sessions per group from the distinct baskets, each a bitmap with its number of sessions."""
    bit = F.coalesce(*[F.when(F.col(item) == F.lit(name), F.lit(1 << i)) for i, name in enumerate(names)]) if names else F.lit(0)
    baskets = entries.groupBy(group, SESSION).agg(F.bit_or(bit.cast("long")).alias("_basket"))
    masks = materialise(baskets.groupBy(group, "_basket").agg(F.count(F.lit(1)).alias("_n")))
    known = F.array(*[F.struct(F.lit(1 << i).cast("long").alias("bit"), F.lit(name).alias("name")) for i, name in enumerate(names)])
    held = F.filter(known, lambda s: F.col("_basket").bitwiseAND(s["bit"]) != 0) if names else F.array()
    opened = masks.withColumn("_held", held)
    singles = opened.select(group, "_n", F.explode("_held").alias("_s")).groupBy(group, F.col("_s.name").alias(item))
    size = F.size("_held")
    later = lambda s, i: F.transform(
        F.slice(F.col("_held"), i + 2, F.greatest(size - i - 1, F.lit(0))), lambda t: F.struct(s["name"].alias("a"), t["name"].alias("b"))
    )
    pairs = opened.select(group, "_n", F.explode(F.flatten(F.transform("_held", later))).alias("_p"))
    pairs = pairs.groupBy(group, F.col("_p.a").alias("item_a"), F.col("_p.b").alias("item_b"))
    return (
        pairs.agg(F.sum("_n").alias("pair_count")),
        singles.agg(F.sum("_n").alias("n")),
        masks.groupBy(group).agg(F.sum("_n").alias("sessions")),
    )


def listed_counts(entries: DataFrame, item: str, group: str, min_pairs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs, singles and sessions per group where items are many."""
    distinct = materialise(entries.distinct())
    sessions = distinct.groupBy(group).agg(F.count_distinct(SESSION).alias("sessions"))
    singles = materialise(distinct.groupBy(group, item).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pairs))
    if min_pairs > 1:
        distinct = materialise(distinct.join(bounded_side(singles.select(group, item)), [group, item], "left_semi"))
    pairs = pair_sums(distinct, item, group=group).withColumnRenamed("total", "pair_count")
    return pairs, singles, sessions


def rules_within(clicks: DataFrame, item: str, group: str, value: str, digits: int = 4) -> DataFrame:
    """Rules of one group, ratios rounded for a report; other groups leave before anything is paired."""
    return rules_of(pair_rules(clicks.filter(F.col(group) == value), item, group), group, value, digits)


def rule_of_two(clicks: DataFrame, item: str, group: str, left: str, right: str) -> DataFrame:
    """The rule of one item pair in every group where a session holds both, by counting sessions alone."""
    low, high = sorted([left, right])
    known = clicks.filter(F.col(item).isNotNull())
    held = known.groupBy(group, SESSION).agg(
        F.max(F.col(item) == low).alias("_a"), F.max(F.col(item) == high).alias("_b")
    )
    counts = held.groupBy(group).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("_a").alias("count_a"), F.count_if("_b").alias("count_b"),
        F.count_if(F.col("_a") & F.col("_b")).alias("pair_count"),
    )
    named = counts.filter("pair_count > 0").withColumns({"item_a": F.lit(low), "item_b": F.lit(high)})
    return with_ratios(named, group)


def directed_rules(rules: DataFrame, group: str) -> DataFrame:
    """Both directions of every pair as rows, with the consequent's own probability."""
    n = F.col("sessions").cast("double")

    def direction(antecedent: str, consequent: str, confidence: str):
        probability = F.col(f"count_{consequent}") / n
        return F.struct(
            F.col(f"item_{antecedent}").alias("antecedent"),
            F.col(f"item_{consequent}").alias("consequent"),
            F.col(confidence).alias("confidence"),
            probability.alias("consequent_probability"),
            (F.col(confidence) / probability).alias("lift"),
            rule_text(F.col(f"item_{antecedent}"), F.col(f"item_{consequent}")).alias("rule"),
        )

    both = F.array(direction("a", "b", "confidence_ab"), direction("b", "a", "confidence_ba"))
    return rules.select(group, "pair_count", "support", F.inline(both))


def strong_rules(rules: DataFrame, min_pairs: int = 5) -> DataFrame:
    """Rules seen often enough, the highest lift first."""
    return rules.filter((F.col("pair_count") >= min_pairs) & (F.col("support") > 0)).orderBy(
        F.desc("lift"), F.desc("confidence_ab"), "item_a", "item_b"
    )


def rules_of(rules: DataFrame, group: str, value: str, digits: int = 4) -> DataFrame:
    """Rules of one group, ratios rounded for a report."""
    ratios = ("support", "confidence_ab", "confidence_ba", "lift")
    return rules.filter(F.col(group) == value).withColumns({c: F.round(c, digits) for c in ratios})


def rule_between(rules: DataFrame, left: str, right: str) -> DataFrame:
    """The rule of one item pair in every group."""
    low, high = sorted([left, right])
    return rules.filter((F.col("item_a") == low) & (F.col("item_b") == high))

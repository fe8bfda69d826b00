"""Sums over pairs of items that share a session.

Every session becomes one array of its distinct items, or several tiles when it has
many. Tasks multiply tiles and add up equal pairs before anything is shuffled, so
the pairs of single sessions never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.scale import bounded_side, counted, materialise
from trailmill.schema import SESSION

TILE = 512
#: Pairs that a task makes at once, some 100 bytes each, and sums that it holds; equal sums that left apart meet in the partial
#: aggregate behind it, which can spill.
PAIRS_AT_ONCE = 1 << 19
FLUSH_ROWS = 1 << 17


def tile_sessions(rows: DataFrame, tile: int, item: str = "_item") -> tuple[DataFrame, bool]:
    """Spread the items of wide sessions over ``_tiles`` tiles of about ``tile`` items.

    Also tells whether there are wide sessions at all.
    """
    wide, n_wide = counted(
        rows.groupBy(SESSION)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > tile)
        .select(SESSION, F.ceil(F.col("_n") / tile).cast("int").alias("_tiles"))
    )
    if n_wide == 0:
        return rows.withColumns({"_tiles": F.lit(1), "_tile": F.lit(0)}), False
    tiled = rows.join(bounded_side(wide), SESSION, "left").withColumn(
        "_tiles", F.coalesce("_tiles", F.lit(1))
    )
    return tiled.withColumn("_tile", F.pmod(F.xxhash64(item), F.col("_tiles")).cast("int")), True


def pair_sums(
    entries: DataFrame, item: str, weight: str | None = None, group: str | None = None, tile: int = TILE
) -> DataFrame:
    """Sum of weight products per unordered item pair, as (group, item_a, item_b, total).

    ``entries`` holds each (session, item) once; it is read twice, so pass a written
    frame where it is costly. Null items make no pairs. Without weights the sum counts shared
    sessions. ``item_a`` < ``item_b``; weights are whole numbers, so sums are exact.
    """
    value = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    key = F.col(group) if group else F.lit(0)
    rows = entries.select(key.alias("_group"), SESSION, F.col(item).alias("_item"), value.alias("_w"))
    rows = rows.filter(F.col("_item").isNotNull())
    tiled, any_wide = tile_sessions(rows, tile)
    tiles = tiled.groupBy("_group", SESSION, "_tiles", "_tile").agg(
        F.collect_list(F.struct("_item", "_w")).alias("_e")
    )
    own = tiles.select(
        "_group",
        F.col("_e._item").alias("left_items"),
        F.col("_e._w").alias("left_w"),
        F.slice("_e._item", 1, 0).alias("right_items"),
        F.slice("_e._w", 1, 0).alias("right_w"),
    )
    if any_wide:
        many = tiles.filter(F.col("_tiles") > 1)
        # each tile meets every later tile of its session, keyed by the later one
        earlier = many.filter(F.col("_tile") < F.col("_tiles") - 1).select(
            "_group",
            SESSION,
            F.col("_e").alias("_left"),
            F.explode(F.sequence(F.col("_tile") + 1, F.col("_tiles") - 1)).alias("_tile"),
        )
        crossed = earlier.join(many, ["_group", SESSION, "_tile"]).select(
            "_group",
            F.col("_left._item").alias("left_items"),
            F.col("_left._w").alias("left_w"),
            F.col("_e._item").alias("right_items"),
            F.col("_e._w").alias("right_w"),
        )
        own = own.unionByName(crossed)
    types = dict(rows.dtypes)
    out = f"_group {types['_group']}, item_a {types['_item']}, item_b {types['_item']}, total long"
    partial = own.mapInPandas(combine_pairs, out)
    summed = partial.groupBy("_group", "item_a", "item_b").agg(F.sum("total").alias("total"))
    return summed.withColumnRenamed("_group", group) if group else summed.drop("_group")


def combine_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pair sums of a task's tiles, flushed whenever they grow large."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        for part in batch_pairs(batch):
            held.append(part)
            size += len(part)
            if size > FLUSH_ROWS:
                merged = merge_pairs(held)
                held, size = [merged], len(merged)
                if size > FLUSH_ROWS // 2:
                    yield merged
                    held, size = [], 0
    if held:
        yield merge_pairs(held)


def merge_pairs(parts: list[pd.DataFrame]) -> pd.DataFrame:
    together = pd.concat(parts, ignore_index=True)
    return together.groupby(["_group", "item_a", "item_b"], as_index=False, sort=False)["total"].sum()


def batch_pairs(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Pair sums of one batch, worked off in slices of bounded pair count."""
    inside = batch["right_items"].str.len().to_numpy() == 0
    right_items = batch["right_items"].where(~inside, batch["left_items"])
    right_w = batch["right_w"].where(~inside, batch["left_w"])
    n_left = batch["left_items"].str.len().to_numpy()
    n_right = right_items.str.len().to_numpy()
    flat = np.concatenate([*batch["left_items"], *right_items])
    codes, names = pd.factorize(flat, sort=True)
    groups, group_names = pd.factorize(batch["_group"])
    cut = int(n_left.sum())
    left_code, right_code = codes[:cut], codes[cut:]
    left_w = np.concatenate(list(batch["left_w"]))
    right_w = np.concatenate(list(right_w))
    left_at = np.concatenate([[0], np.cumsum(n_left)])
    right_at = np.concatenate([[0], np.cumsum(n_right)])
    pieces = np.cumsum(n_left * n_right) // PAIRS_AT_ONCE
    for piece in np.unique(pieces):
        rows = np.flatnonzero(pieces == piece)
        left = np.arange(left_at[rows[0]], left_at[rows[-1] + 1])
        row = np.repeat(rows, n_left[rows])
        reps = n_right[row]
        first = np.repeat(left, reps)
        start = np.repeat(right_at[row], reps)
        step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        second = start + step
        a, b = left_code[first], right_code[second]
        w = left_w[first] * right_w[second]
        owner = np.repeat(row, reps)
        # inside one tile each pair shows up in both directions: keep one of them
        keep = np.where(inside[owner], a < b, a != b)
        a, b, w, owner = a[keep], b[keep], w[keep], owner[keep]
        low, high = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
        key = (groups[owner].astype(np.int64) * len(names) + low) * len(names) + high
        found, back = np.unique(key, return_inverse=True)
        total = np.bincount(back, weights=w, minlength=len(found)).astype(np.int64)
        yield pd.DataFrame(
            {
                "_group": group_names[found // len(names) // len(names)],
                "item_a": names[found // len(names) % len(names)],
                "item_b": names[found % len(names)],
                "total": total,
            }
        )

"""Session vectors pooled from item vectors.

Where the item vectors fit into the tasks, item numbers and weights travel and the vectors are looked up where they
are added; otherwise vectors are joined to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.functions.arrays import unit
from trailmill.operators import catalogue
from trailmill.operators.sequences import next_click
from trailmill.scale import SPAN, bounded_side, hinted, is_small, materialise, scan_tasks, span_of, spread, watched
from trailmill.schema import ITEM, ORDER, SESSION

#: Rows that a task of a scan gets on average; each becomes a vector, and what follows works on it in the same task.
ROWS_A_TASK = 32_768


def mean_pool(clicks: DataFrame, vectors: DataFrame, item: str = ITEM) -> DataFrame:
    """Mean item vector of each session, and the same at length one.

    Repeated items are counted before their vectors are joined.
    """
    counts = clicks.groupBy(SESSION, item).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    given = vectors.select(item, "vector").filter(F.col(item).isNotNull() & F.col("vector").isNotNull())
    known = materialise(given.withColumn("_no", F.monotonically_increasing_id()))
    gaps = F.count_if(F.exists("vector", F.isnull))
    n, distinct, broken = known.agg(F.count(F.lit(1)), F.count_distinct(item), gaps).first()
    if n == distinct and not broken:
        numbered = counts.join(hinted(known.select(item, "_no"), is_small(n)), item)
        pooled = weighted_pool(numbered.select(SESSION, "_no", "weight"), known, "_no", mean=True)
        pooled = pooled.withColumnRenamed("vector", "pooled")
    else:  # an item with several vectors counts with each of them; a vector with gaps is an error of the mean
        joined = counts.join(bounded_side(known.select(item, "vector")), item)
        mean = Summarizer.mean(array_to_vector("vector"), F.col("weight"))
        pooled = joined.groupBy(SESSION).agg(vector_to_array(mean).alias("pooled"))
    return pooled.withColumn("unit", unit(F.col("pooled")))


def decayed_pool(context: DataFrame, vectors: DataFrame, decay: float = 0.8, item: str = ITEM) -> DataFrame:
    """Sum of item vectors weighted by decay ^ (clicks from the session's last one).

    Positions count all clicks; items without a vector drop out afterwards.
    """
    ends = context.groupBy(SESSION).agg(F.max(ORDER).alias("_last"))
    weight = F.pow(F.lit(decay), F.col("_last") - F.col(ORDER))
    weights = context.join(ends, SESSION).groupBy(SESSION, item).agg(F.sum(weight).alias("weight"))
    return weighted_pool(weights, vectors, item)


def last_prefix(clicks: DataFrame, item: str = ITEM) -> DataFrame:
    """Length of the longest prefix of each session that has a next click: (session, ``_end``)."""
    last = F.max(F.when(F.col(item).isNotNull(), F.col(ORDER)))
    return clicks.groupBy(SESSION).agg((last - 1).alias("_end")).filter("_end >= 1")


def last_prefix_pool(clicks: DataFrame, vectors: DataFrame, decay: float = 0.01, item: str = ITEM) -> DataFrame:
    """``prefix_pool`` for the longest prefix only, from one row per session and item.

    Weights are taken relative to the newest first position, so they do not vanish together in a long session.
    """
    inside = clicks.join(last_prefix(clicks, item), SESSION).filter(F.col(ORDER) <= F.col("_end"))
    seen = inside.groupBy(SESSION, item).agg(F.count(F.lit(1)).alias("_n"), F.min(ORDER).alias("_first"))
    known = seen.join(bounded_side(vectors.filter("vector is not null").select(item)), item, "left_semi")
    newest = known.groupBy(SESSION).agg(F.max("_first").alias("_newest"))
    weight = F.col("_n") * F.pow(F.lit(decay), F.col("_newest") - F.col("_first"))
    weights = known.join(newest, SESSION).select(SESSION, item, weight.cast("double").alias("weight"))
    return weighted_pool(weights, vectors, item, mean=True)


def weighted_pool(weights: DataFrame, vectors: DataFrame, item: str, mean: bool = False) -> DataFrame:
    """(session, vector): sum or mean of item vectors by weight, from one row per session and item."""
    known = catalogue.sent(vectors, item)
    if known is None:
        joined = weights.join(bounded_side(vectors.select(item, "vector")), item)
        combine = Summarizer.mean if mean else Summarizer.sum
        return joined.groupBy(SESSION).agg(vector_to_array(combine(array_to_vector("vector"), F.col("weight"))).alias("vector"))
    kind = dict(weights.dtypes)[SESSION]

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = known.value
        held: tuple | None = None
        for batch in batches:
            at = items.positions(batch.column("_item").to_numpy(zero_copy_only=False))
            given = batch.column(SESSION).filter(pa.array(at >= 0))
            if not len(given):
                continue
            weight = batch.column("weight").to_numpy(zero_copy_only=False)[at >= 0]
            keys = given.dictionary_encode(null_encoding="encode").indices.to_numpy()
            begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sums = np.add.reduceat(items.vectors[at[at >= 0]] * weight[:, None], begins, axis=0)
            masses, names = np.add.reduceat(weight, begins), given.take(pa.array(begins))
            if held is not None and held[0][0].as_py() == names[0].as_py():
                sums[0] += held[1][0]
                masses[0] += held[2][0]
            elif held is not None:
                yield rows(*held)
            yield rows(names[:-1], sums[:-1], masses[:-1])
            held = names[-1:], sums[-1:], masses[-1:]
        if held is not None:
            yield rows(*held)

    def rows(names, sums, masses) -> pa.RecordBatch:
        found = sums / masses[:, None] if mean else sums
        return pa.RecordBatch.from_arrays([names, list_rows(found)], [SESSION, "vector"])

    placed = weights.filter(F.col(item).isNotNull()).select(SESSION, F.col(item).cast("long").alias("_item"), "weight")
    placed = placed.repartition(scan_tasks(weights.sparkSession), SESSION).sortWithinPartitions(SESSION)
    return placed.mapInArrow(pool, f"{SESSION} {kind}, vector array<double>")


def list_rows(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(ends, np.ascontiguousarray(values).ravel())


def prefix_pool(
    clicks: DataFrame, vectors: DataFrame, decay: float = 0.01, item: str = ITEM, span: int = SPAN
) -> DataFrame:
    """Pooled vector of every prefix that has a next click.

    An item occurrence weighs decay ^ (prefix end - first position of the item), and
    weights are normalised per prefix. The prefix end cancels in the normalised
    weights, so a scan in click order keeps a running sum with the newest first
    position as its unit, and neither builds prefixes nor underflows. The scan runs over all rows of an Arrow batch
    at once, in as many doubling steps as the longest session there asks for. A session longer
    than ``span`` clicks is scanned span by span; each span starts from the merged sums
    of the spans before it.
    """
    if not 0 < decay <= 1:
        raise ValueError("decay must lie between 0 and 1")
    known = catalogue.sent(vectors, item)
    rows = materialise(next_click(clicks, item, 1).select(SESSION, ORDER, item, "next"))
    firsts = rows.groupBy(SESSION, item).agg(F.min(ORDER).cast("long").alias("_first"))
    marked = rows.join(firsts, [SESSION, item])
    if known is None:
        marked = marked.join(bounded_side(vectors.select(item, F.col("vector").cast("array<double>").alias("vector"))), item, "left")
    else:
        marked = marked.withColumn("vector", F.lit(None).cast("array<double>"))
    number = F.lit(None) if known is None else F.col(item)
    scanned, last = watched(
        marked.withColumn("_span", span_of(ORDER, span))
        .withColumn("_mass", F.when(F.col("vector").isNotNull(), 1.0))
        .select(SESSION, "_span", ORDER, "next", "_first", "_mass", number.cast("long").alias("_item"), "vector"),
        F.max("_span"),
    )
    parts = spread(scanned, ROWS_A_TASK)
    types = dict(scanned.dtypes)
    state = f"{SESSION} {types[SESSION]}, _span long, _first long, _mass double, vector array<double>"

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition(parts, SESSION, "_span").sortWithinPartitions(SESSION, "_span", ORDER)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, first, mass, total in scans(batches, known, decay):
            keep = np.flatnonzero((mass > 0) & batch.column("next").is_valid().to_numpy(zero_copy_only=False))
            kept = batch.select([SESSION, ORDER, "next"]).take(pa.array(keep))
            found = list_rows(total[keep] / mass[keep, None])
            yield pa.RecordBatch.from_arrays([*kept.columns, found], [SESSION, ORDER, "next", "vector"])

    def span_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch, begins, first, mass, total in scans(batches, known, decay):
            ends = np.append(begins[1:], batch.num_rows) - 1
            keys = batch.select([SESSION, "_span"])
            if held is not None and held[0].slice(0, 1) != keys.slice(0, 1):
                yield sums(*held)
            yield sums(keys.take(pa.array(ends[:-1])), first[ends[:-1]], mass[ends[:-1]], total[ends[:-1]])
            held = keys.take(pa.array(ends[-1:])), first[ends[-1:]], mass[ends[-1:]], total[ends[-1:]]
        if held is not None:
            yield sums(*held)

    def sums(keys: pa.RecordBatch, first, mass, total) -> pa.RecordBatch:
        some = np.flatnonzero(mass > 0)
        columns = [*keys.take(pa.array(some)).columns, pa.array(first[some]), pa.array(mass[some]), list_rows(total[some])]
        return pa.RecordBatch.from_arrays(columns, [SESSION, "_span", "_first", "_mass", "vector"])

    def carries(spans: pd.DataFrame) -> pd.DataFrame:
        """What each span of one session starts from; one input row per span."""
        ends = {
            number: state
            for number, *state in zip(*(spans[c] for c in ("_span", "_first", "_mass", "vector")))
        }
        sums, out = DecayedSums(decay), []
        for number in range(int(spans["_last"].iloc[0]) + 1):
            out += sums.row([spans[SESSION].iloc[0], number])
            if number in ends:
                sums.add(*ends[number])
        return pd.DataFrame(out, columns=[SESSION, "_span", "_first", "_mass", "vector"])

    started = scanned
    if last:
        long_sessions = scanned.groupBy(SESSION).agg(F.max("_span").alias("_last")).filter(F.col("_last") > 0)
        side = bounded_side(long_sessions)
        totals = in_order(scanned.join(side.select(SESSION), SESSION, "left_semi")).mapInArrow(span_sums, state)
        starts = totals.join(side, SESSION).groupBy(SESSION).applyInPandas(carries, state)
        blank = {ORDER: F.lit(0).cast(types[ORDER]), "next": F.lit(None).cast(types["next"]), "_item": F.lit(None).cast("long")}
        started = scanned.unionByName(starts.withColumns(blank))
    out = f"{SESSION} {types[SESSION]}, {ORDER} {types[ORDER]}, next {types['next']}, vector array<double>"
    return in_order(started).mapInArrow(pool, out)


def decayed_scan(first: np.ndarray, mass: np.ndarray, total: np.ndarray, begin: np.ndarray, decay: float) -> None:
    """Running sums inside segments, in place; ``begin`` is the first row of a row's segment.

    A state is a sum whose unit is the weight at its newest first position; two states combine in any grouping.
    """
    place = np.arange(len(first))
    depth, shift = place - begin, 1
    while (depth >= shift).any():
        rows = np.flatnonzero(depth >= shift)
        before = rows - shift
        newest = np.maximum(first[rows], first[before])
        own, other = decay ** (newest - first[rows]), decay ** (newest - first[before])
        masses = mass[rows] * own + mass[before] * other
        sums = total[rows] * own[:, None] + total[before] * other[:, None]
        first[rows], mass[rows], total[rows] = newest, masses, sums
        shift *= 2


def scans(batches: Iterator[pa.RecordBatch], known, decay: float) -> Iterator[tuple]:
    """Batches of rows in click order with the first rows of their segments and the running first, mass and sum."""
    held = None
    for batch in catalogue.slices(batches, 16_384):
        given = batch.column("vector").is_valid().to_numpy(zero_copy_only=False)
        mass = np.nan_to_num(batch.column("_mass").to_numpy(zero_copy_only=False).astype(np.float64))
        some = catalogue.matrix(batch.column("vector").filter(pa.array(given)))
        at = np.full(batch.num_rows, -1)
        if known is not None:
            items = batch.column("_item")
            at = known.value.positions(items.fill_null(-1).to_numpy(zero_copy_only=False))
            at[~items.is_valid().to_numpy(zero_copy_only=False)] = -1
            mass[at >= 0] = 1.0
        width = known.value.vectors.shape[1] if known is not None else some.shape[1] or (len(held[3]) if held else 0)
        total = np.zeros((batch.num_rows, width))
        if known is not None:
            total[at >= 0] = known.value.vectors[at[at >= 0]]
        if given.any():
            total[given] = some
        first = np.where(mass > 0, batch.column("_first").fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.float64)
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in (SESSION, "_span")]
        change = np.append(True, (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))
        begins = np.flatnonzero(change)
        if held is not None and held[0] == (keys[0][0], keys[1][0]) and len(held[3]) == width:
            newest = max(first[0], held[1])
            own, other = decay ** (newest - first[0]), decay ** (newest - held[1])
            total[0] = total[0] * own + held[3] * other
            mass[0], first[0] = mass[0] * own + held[2] * other, newest
        decayed_scan(first, mass, total, begins[np.cumsum(change) - 1], decay)
        held = (keys[0][-1], keys[1][-1]), first[-1], mass[-1], total[-1].copy()
        yield batch, begins, first.astype(np.int64), mass, total


class DecayedSums:
    """Weighted vector sum whose unit is the weight of the newest first position."""

    def __init__(self, decay: float):
        self.decay, self.newest, self.mass, self.total = decay, 0, 0.0, None

    def add(self, first: int, mass: float, vector) -> None:
        fresh = np.asarray(vector, dtype=np.float64)
        if self.total is None:
            self.newest, self.mass, self.total = first, mass, fresh * 1.0
            return
        if first > self.newest:
            fade = self.decay ** (first - self.newest)
            self.newest, self.mass, self.total = first, self.mass * fade, self.total * fade
        gain = self.decay ** (self.newest - first)
        self.mass += mass * gain
        self.total = self.total + fresh * gain

    def mean(self):
        return None if self.total is None else self.total / self.mass

    def row(self, key) -> list[tuple]:
        return [] if self.total is None else [(*key, self.newest, self.mass, self.total)]

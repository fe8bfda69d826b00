"""A catalogue of item vectors that is sent whole to the tasks which hold the queries.

``sent`` measures the catalogue first and returns None when it is larger than the limit in bytes; callers then take a
path that exchanges vectors. Items are packed by falling length into blocks, each with its centre, radius and largest
length, so a query leaves out the blocks whose best possible score lies below the k-th score it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of vectors that are sent to every task.
SENT_BYTES = 64 << 20
BLOCK = 4_096
#: Items of a block that are scored at once.
TILE = 1_024
#: Digits that decide ranks, and how far below the k-th score a bound must lie.
DIGITS = 9
SLACK = 1e-8


@dataclass
class Catalogue:
    """Item numbers and vectors in packed order."""

    ids: np.ndarray
    vectors: np.ndarray
    block: int = BLOCK
    begins: np.ndarray = field(init=False)
    centres: np.ndarray = field(init=False)
    radii: np.ndarray = field(init=False)
    longest: np.ndarray = field(init=False)

    def __post_init__(self):
        lengths = np.linalg.norm(self.vectors, axis=1)
        order = np.lexsort((self.ids, -lengths))
        self.ids, self.vectors, lengths = self.ids[order], self.vectors[order], lengths[order]
        self.order = order
        self.begins = np.arange(0, len(self.ids), self.block)
        parts = [slice(b, b + self.block) for b in self.begins]
        width = self.vectors.shape[1]
        self.centres = np.array([self.vectors[p].mean(axis=0) for p in parts]).reshape(-1, width)
        self.radii = np.array([np.linalg.norm(self.vectors[p] - c, axis=1).max() for p, c in zip(parts, self.centres)])
        self.longest = np.array([lengths[p].max() for p in parts])
        self.sorted = np.argsort(self.ids, kind="stable")
        self.width, self.most = width, float(self.longest[np.isfinite(self.longest)].max(initial=0.0))
        self.single: np.ndarray | None = None

    def as_type(self, kind: type) -> np.ndarray:
        """The vectors in a number type; the single-precision copy is made once, where it is used."""
        if kind is np.float64:
            return self.vectors
        if self.single is None:
            self.single = self.vectors.astype(np.float32)
        return self.single

    def positions(self, wanted: np.ndarray) -> np.ndarray:
        """Packed position of each item number, -1 where it is not in the catalogue."""
        if not len(self.ids):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.ids, wanted, sorter=self.sorted), len(self.ids) - 1)
        found = self.sorted[at]
        return np.where(self.ids[found] == wanted, found, -1)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls and of one width."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows at length one, as ``arrays.unit`` has them: squares are added one after another, a zero row stays as it is."""
    total = np.zeros(len(rows))
    for column in rows.T:
        total += column * column
    length = np.sqrt(total)
    length[length == 0] = 1.0
    return rows / length[:, None]


def sent(items: DataFrame, item: str = "item_idx", limit: int | None = None) -> Broadcast | None:
    """The catalogue as a broadcast value if its vectors take no more than ``limit`` bytes and items are numbers, else None."""
    if not isinstance(items.schema[item].dataType, T.IntegralType):
        return None
    rows = items.filter(F.col(item).isNotNull() & F.col("vector").isNotNull()).select(
        F.col(item).cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")
    )
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if n * 8 * ((width or 0) + 2) > (SENT_BYTES if limit is None else limit):
        return None
    table = rows.toArrow()
    ids = table.column("id").to_numpy()
    found = Catalogue(ids, matrix(table.column("vector").combine_chunks()).reshape(len(ids), width or 0))
    return items.sparkSession.sparkContext.broadcast(found)


def narrow(lengths: np.ndarray, longest: float) -> type:
    """Number type of a first look at all scores: single precision unless the products could leave its range."""
    reach = float(np.max(lengths, initial=0.0)) * longest
    return np.float32 if np.isfinite(reach) and reach < 1e30 else np.float64


def margins(lengths: np.ndarray, longest: float, width: int, kind: type) -> np.ndarray:
    """How far a score in ``kind`` may lie from the score that is rounded in double precision, per query.

    A sum of n products is off by no more than n + 2 roundings of the product of both lengths; limits are rounded once more.
    """
    return (width + 8) * float(np.finfo(kind).eps) * lengths * longest + 2 * 10.0**-DIGITS


def row_counts(hits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.packbits(hits, axis=1)).sum(axis=1, dtype=np.int64)


def places_set(hits: np.ndarray) -> np.ndarray:
    """Flat places of few hits among many, looked for byte by byte of eight places."""
    packed = np.packbits(hits)
    held = np.flatnonzero(packed)
    byte, bit = np.nonzero(np.unpackbits(packed[held, None], axis=1))
    return held[byte] * 8 + bit


def exact_scores(queries: np.ndarray, rows: np.ndarray, items: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.round(np.einsum("ij,ij->i", queries[rows], items[at]), DIGITS)


class Kept:
    """The best items of each query so far, ``k`` (one number or one per query) with scores from ``least`` on.

    Equal scores go by item number. Finds wait until there are as many as queries, then they are sorted in at once.
    """

    def __init__(self, many: int, k: int | np.ndarray, least: float = -np.inf):
        self.k = np.broadcast_to(np.asarray(k, dtype=np.int64), many)
        self.floor = np.full(many, least)
        self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.waiting, self.n_waiting = [], 0

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.floor[rows]
        self.waiting.append((rows[keep], ids[keep], scores[keep]))
        self.n_waiting += int(keep.sum())
        if self.n_waiting >= len(self.floor):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.n_waiting:
            rows, ids, scores = (np.concatenate(x) for x in zip(self.held, *self.waiting, strict=True))
            order = np.lexsort((ids, -scores, rows))
            rows, ids, scores = rows[order], ids[order], scores[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            last = place == self.k[rows] - 1
            self.floor[rows[last]] = np.maximum(self.floor[rows[last]], scores[last])
            keep = place < self.k[rows]
            self.held = rows[keep], ids[keep], scores[keep]
        self.waiting, self.n_waiting = [], 0
        return self.held


def likely(shown: np.ndarray, floor: np.ndarray, gaps: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all scores that may be among the k best of their row, given how far they may be off.

    ``floor`` is a score that the k best reach at least; a score of minus infinity is left out. Where more than a few columns reach it, the k-th score here is a second limit.
    """
    limit = floor - gaps
    hits = shown >= limit[:, None].astype(shown.dtype)
    counts = row_counts(hits)
    many = np.flatnonzero((counts > 2 * k + 8) & (k < shown.shape[1]))
    if len(many):
        places = np.unique(k[many] - 1)
        ordered = -np.partition(-shown[many], places, axis=1)
        kth = ordered[np.arange(len(many)), k[many] - 1].astype(np.float64)
        limit[many] = np.fmax(limit[many], kth - 2 * gaps[many])
        hits[many] &= shown[many] >= limit[many, None].astype(shown.dtype)
    some = np.flatnonzero(counts)
    row, column = np.divmod(np.flatnonzero(hits[some]), shown.shape[1])
    row = some[row]
    free = shown[row, column] > -np.inf
    return row[free], column[free]


def best(
    catalogue: Catalogue, queries: np.ndarray, k: int | np.ndarray, barred: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, item number and score of the k best items per query, scores rounded, equal ones by item number.

    ``barred`` names (query row, packed position) pairs that are left out. All items of the blocks in reach are looked at in
    single precision; what may be among the best by the bound of its error is scored again in double precision.
    """
    many = len(queries)
    kept = Kept(many, k)
    lengths = np.linalg.norm(queries, axis=1)
    kind = narrow(lengths, catalogue.most)
    gaps, asked, items = margins(lengths, catalogue.most, catalogue.width, kind), queries.astype(kind), catalogue.as_type(kind)
    at = np.full(many, -1)
    if barred is not None:
        order = np.argsort(barred[1], kind="stable")
        barred = barred[0][order], barred[1][order]
    for b, begin in enumerate(catalogue.begins):
        reach = np.minimum(lengths * catalogue.longest[b], queries @ catalogue.centres[b] + lengths * catalogue.radii[b])
        active = np.flatnonzero(reach >= kept.floor - SLACK)
        if not len(active):
            continue
        at[:] = -1
        at[active] = np.arange(len(active))
        near, end = asked[active], min(begin + catalogue.block, len(catalogue.ids))
        for start in range(begin, end, TILE):
            stop = min(start + TILE, end)
            shown = near @ items[start:stop].T
            if barred is not None:
                part = slice(*np.searchsorted(barred[1], [start, stop]))
                owner, column = at[barred[0][part]], barred[1][part] - start
                shown[owner[owner >= 0], column[owner >= 0]] = -np.inf
            row, column = likely(shown, kept.floor[active], gaps[active], kept.k[active])
            row, column = active[row], column + start
            kept.add(row, catalogue.ids[column], exact_scores(queries, row, catalogue.vectors, column))
    return kept.merge()


def best_of(
    catalogue: Catalogue,
    at: np.ndarray,
    queries: np.ndarray,
    k: int,
    least: float,
    barred: Callable[[np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best`` among the items at given packed positions that score ``least`` or more.

    ``barred`` gives the pairs to leave out, as rows of all queries, for some of the positions.
    """
    kept = Kept(len(queries), k, least)
    lengths = np.linalg.norm(queries, axis=1)
    kind = narrow(lengths, catalogue.most)
    gaps, asked, items = margins(lengths, catalogue.most, catalogue.width, kind), queries.astype(kind), catalogue.as_type(kind)
    for start in range(0, len(at), TILE):
        part = at[start : start + TILE]
        shown = asked @ items[part].T
        if barred is not None:
            shown[barred(part)] = -np.inf
        row, column = likely(shown, kept.floor, gaps, kept.k)
        kept.add(row, catalogue.ids[part[column]], exact_scores(queries, row, catalogue.vectors, part[column]))
    return kept.merge()


def count_above(catalogue: Catalogue, queries: np.ndarray, own: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many items score above ``own`` for each query, or equal to it with a number below ``wanted``.

    Counted block by block, without a list; blocks that cannot reach the score are left out. Scores are counted in single
    precision, and those that its error could put on either side of ``own`` are worked out again in double precision.
    """
    above = np.zeros(len(queries), dtype=np.int64)
    lengths = np.linalg.norm(queries, axis=1)
    kind = narrow(lengths, catalogue.most)
    gaps, asked, items = margins(lengths, catalogue.most, catalogue.width, kind), queries.astype(kind), catalogue.as_type(kind)
    for b, begin in enumerate(catalogue.begins):
        reach = np.minimum(lengths * catalogue.longest[b], queries @ catalogue.centres[b] + lengths * catalogue.radii[b])
        active = np.flatnonzero(reach >= own - SLACK)
        if not len(active):
            continue
        low, high = ((own + gap)[active, None].astype(kind) for gap in (-gaps, gaps))
        near, end = asked[active], min(begin + catalogue.block, len(catalogue.ids))
        for start in range(begin, end, TILE):
            shown = near @ items[start : min(start + TILE, end)].T
            sure, open_ = shown > high, shown >= low
            above[active] += row_counts(sure)
            row, column = np.divmod(places_set(open_ != sure), shown.shape[1])
            row, column = active[row], column + start
            scores = exact_scores(queries, row, catalogue.vectors, column)
            hit = (scores > own[row]) | ((scores == own[row]) & (catalogue.ids[column] < wanted[row]))
            above += np.bincount(row[hit], minlength=len(queries))
    return above


def ranks_of(catalogue: Catalogue, queries: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rank of a wanted item among all items by score, equal ones by item number; 0 where it is not in the catalogue."""
    at = catalogue.positions(wanted)
    out = np.zeros(len(queries), dtype=np.int64)
    rows = np.flatnonzero(at >= 0)
    if len(rows):
        asked = queries[rows]
        own = np.round(np.einsum("ij,ij->i", asked, catalogue.vectors[at[rows]]), DIGITS)
        out[rows] = count_above(catalogue, asked, own, wanted[rows]) + 1
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)

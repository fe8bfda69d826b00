"""What searches over vectors share: integer rows, blocks of queries, and the best rows found so far."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.storage import stored

#: Most queries that are sent to all tasks at once; beyond it the candidates are read once per block of queries.
QUERIES = 16_384


def quantised(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))


def complete(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(False))


def dense_rows(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows whose vector is complete, and their vectors times ``scale``, rounded down.

    Shorter vectors are filled up with zeros.
    """
    sizes = pc.list_value_length(column)
    present = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(column)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)
    lengths = sizes.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    bad = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(~np.isfinite(values), out=bad[1:])  # a null became NaN
    fine = bad[ends] == bad[ends - lengths]
    kept, lengths, starts = present[fine], lengths[fine], (ends - lengths)[fine]
    width = int(lengths.max(initial=0))
    at = starts[:, None] + np.arange(width)
    inside = np.arange(width) < lengths[:, None]
    picked = np.where(inside, values[np.where(inside, at, 0)], 0.0) if width else np.zeros((len(kept), 0))
    return kept, np.floor(picked * scale).astype(np.int64)


def padded(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_blocks(queries: DataFrame, name: str, size: int = QUERIES) -> tuple[DataFrame, int]:
    """``queries`` written with a number ``qid`` per row and a ``block``; and the number of blocks."""
    numbered = stored(queries.withColumn("qid", F.monotonically_increasing_id()), name)
    blocks = max(1, -(-numbered.count() // size))
    return numbered.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")), blocks


class Best:
    """The k best (score, then smaller id) per slot of the rows added so far."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, np.iinfo(np.int64).min)
        self.rows = [np.zeros(0, dtype=np.int64)] * 3

    def add(self, slots: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rows of which those under the floor of their slot may be left out."""
        if not len(slots):
            return
        slots, ids, scores = (np.concatenate(x) for x in zip(self.rows, (slots, ids, scores), strict=True))
        order = np.lexsort((ids, -scores, slots))
        slots, ids, scores = slots[order], ids[order], scores[order]
        place = np.arange(len(slots)) - np.searchsorted(slots, slots, side="left")
        last = place == self.k - 1
        self.floor[slots[last]] = scores[last]
        self.rows = [x[place < self.k] for x in (slots, ids, scores)]

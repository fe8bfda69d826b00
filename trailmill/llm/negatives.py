"""Hard negatives by Four-Russians scoring.

Vectors become integer rows. The dimensions are cut into groups of eight. For each anchor and group a table holds the sums of
all 256 subsets of the anchor's eight components, built by one addition per entry. Candidates are
stored as bit planes: plane b of a group is a byte with bit b of each of its eight components, and the highest plane is the sign. A
score is then the sum over groups of the looked-up subset sums, shifted and added from the highest plane to
the lowest: the full inner product, exactly.

Anchors are cut into blocks of bounded size that are sent to the tasks which read the candidates, so candidates are
never exchanged. One pass finds the positives, the best rows of an anchor's label. A second pass finds, for
the window of scores that each positive opens, the best rows of other labels. A task returns at most k rows per window, and
the lists of all tasks merge per window.

Defined cases: rows with a null id, null label or null vector, or with null or non-finite components take no part; a missing
component counts as 0; equal scores go by the smaller id; a row is never its own positive, but rows that repeat id,
label and vector are rows of their own, both as anchors and as candidates; anchors without positives or
negatives give no rows; an empty table gives no rows. Scores are exact while they fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmill.llm.storage import stored
from trailmill.llm.vectors import Best, chunks, complete, dense_rows, padded, quantised, with_blocks

GROUP = 8
CHUNK = 8_192
#: Anchors whose tables are held at once: 64 x 8 groups x 256 sums are 1 MB for 64 dimensions.
ANCHORS = 64
FOUND = "qid long, slot int, vec_id long, score long"
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of eight components; bit 7 of the index is the first."""
    many, width = anchors.shape
    groups = -(-width // GROUP)
    parts = padded(anchors, groups * GROUP).reshape(many, groups, GROUP)
    table = np.zeros((groups, 1 << GROUP, many), dtype=anchors.dtype)
    for bit in range(GROUP):
        half = 1 << bit
        table[:, half : 2 * half] = table[:, :half] + parts[:, :, GROUP - 1 - bit].T[:, None, :]
    return table


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows): bytes of the bits of eight components, lowest plane first, the sign last."""
    many, width = rows.shape
    groups = -(-width // GROUP)
    parts = padded(rows, groups * GROUP)
    largest = max(int(parts.max(initial=0)), ~int(parts.min(initial=0)))
    planes = largest.bit_length() + 1
    packed = [np.packbits(((parts >> b) & 1).astype(np.uint8), axis=1) for b in range(planes)]
    return np.stack([p.reshape(many, groups).T for p in packed])


def scores_of(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products, by lookups that are shifted and added."""
    total = np.zeros((planes.shape[2], table.shape[2]), dtype=table.dtype)
    for b in range(len(planes) - 1, -1, -1):
        total += total
        for group, index in zip(table, planes[b], strict=True):
            if b == len(planes) - 1:
                total -= group[index]
            else:
                total += group[index]
    return total


def table_type(anchors: np.ndarray, planes: int) -> type:
    """32 bits where no partial sum can leave them."""
    reach = int(np.abs(anchors).max(initial=0)) * max(anchors.shape[1], 1) << planes
    return np.int32 if reach < 1 << 31 else np.int64


def scanned(anchors, k: int, scale: float, same_label: bool, chunk: int):
    """Best k candidates per window of scores of the anchors of a broadcast block.

    A block is qids, ids, labels, vectors, and the lower and upper ends of the windows, one row per slot.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, anchor_ids, anchor_labels, vectors, low, high = anchors.value
        parts = [slice(at, at + ANCHORS) for at in range(0, len(qids), ANCHORS)]
        found = [[Best(len(qids[p]), k) for _ in low] for p in parts]
        for batch in chunks(batches, chunk):
            kept, rows = dense_rows(batch.column("vector"), scale)
            if not len(kept):
                continue
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False)[kept] for c in ("vec_id", "label"))
            planes = bit_planes(rows)
            for part, best in zip(parts, found, strict=True):
                own = vectors[part]
                table = subset_sums(own.astype(table_type(own, len(planes))))
                shared = min(len(table), planes.shape[1])  # components that one side lacks count as 0
                scores = scores_of(table[:shared], planes[:, :shared])
                allowed = (labels[:, None] == anchor_labels[None, part]) == same_label
                if same_label:
                    self_row(allowed, ids, rows, anchor_ids[part], own)
                for slot, state in enumerate(best):
                    least = np.maximum(low[slot][part], state.floor)
                    row, column = np.nonzero(allowed & (scores >= least) & (scores <= high[slot][part]))
                    state.add(column, ids[row], scores[row, column].astype(np.int64))
        out = [(qids[part][s.rows[0]], np.full(len(s.rows[0]), slot, np.int32), *s.rows[1:]) for part, best in zip(parts, found, strict=True) for slot, s in enumerate(best)]
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "slot", "vec_id", "score"])

    return scan


def self_row(allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray, anchor_ids: np.ndarray, own: np.ndarray) -> None:
    """Rows equal to an anchor are no candidates of it here; the merge adds those that repeat it."""
    order = np.argsort(ids, kind="stable")
    begins, ends = (np.searchsorted(ids, anchor_ids, side=s, sorter=order) for s in ("left", "right"))
    width = max(rows.shape[1], own.shape[1])
    for column in np.flatnonzero(ends > begins):
        at = order[begins[column] : ends[column]]
        equal = (padded(rows[at], width) == padded(own[column][None, :], width)).all(axis=1)
        allowed[at[equal], column] = False


def share(percent: int, scores: np.ndarray, up: bool) -> np.ndarray:
    """``percent`` of whole scores, rounded up or down, without leaving whole numbers."""
    whole, rest = np.divmod(scores, 100)
    return percent * whole + (-(-percent * rest // 100) if up else percent * rest // 100)


def sent_block(anchors: DataFrame, block: int, slots: int, percent: tuple[int, int] | None):
    """One block of anchors as arrays: a window per score in ``scores``, or one window that is open to both sides."""
    names = ("qid", "vec_id", "label")
    rows = anchors.where(F.col("block") == block)
    table = rows.select(*names, "scores", F.col("v").cast("array<double>").alias("v")).toArrow()
    _, vectors = dense_rows(table.column("v").combine_chunks(), 1.0)
    qids, ids, labels = (table.column(c).to_numpy() for c in names)
    low, high = np.full((slots, len(qids)), MOST), np.full((slots, len(qids)), LEAST)
    if percent is None:
        low[:], high[:] = LEAST, MOST
    else:
        for i, row in enumerate(table.column("scores").to_pylist()):
            scores = np.array(row, dtype=np.int64)
            low[: len(row), i], high[: len(row), i] = share(percent[0], scores, True), share(percent[1], scores, False)
    return anchors.sparkSession.sparkContext.broadcast((qids, ids, labels, vectors, low, high))


def best_in_windows(
    rows: DataFrame, anchors: DataFrame, blocks: int, slots: int, k: int, scale: float, percent: tuple[int, int] | None, chunk: int
) -> DataFrame:
    """qid, slot, vec_id and score of the best k rows per window and task; of the same label where ``percent`` is None."""
    found = None
    for block in range(blocks):
        scan = scanned(sent_block(anchors, block, slots, percent), k, scale, percent is None, chunk)
        part = rows.mapInArrow(scan, FOUND)
        found = part if found is None else found.union(part)
    return found


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("qid", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100),
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = 256.0, chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row that ``anchors`` (over vec_id) takes, its best ``positives`` rows of the same label; for each of these the best
    ``negatives`` rows of other labels that score between the two percentages of the positive's score.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")
    ).where("vec_id is not null and label is not null")
    asked = rows.where(anchors).where(complete(F.col("vector")))
    asked = asked.groupBy("vec_id", "label", quantised(F.col("vector"), scale).alias("v")).agg(F.count(F.lit(1)).alias("copies"))
    asked, blocks = with_blocks(asked, "anchors")

    whole = asked.withColumn("scores", F.lit(None).cast("array<bigint>"))
    found = best_in_windows(rows, whole, blocks, 1, positives, scale, None, chunk)
    own = asked.where("copies > 1").select(
        "qid", F.lit(0).alias("slot"), "vec_id", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("score"),
        F.explode(F.sequence(F.lit(1), F.least(F.col("copies") - 1, F.lit(positives)).cast("int"))).alias("_nth"),
    )
    pairs = stored(
        ranked(found.union(own.drop("_nth")), positives).select(
            "qid", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )

    lists = pairs.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("w"))
    opened = stored(
        asked.join(lists, "qid").select("qid", "block", "vec_id", "label", "v", F.col("w.positive_score").alias("scores")), "windows"
    )
    found = ranked(best_in_windows(rows, opened, blocks, positives, negatives, scale, percent, chunk), negatives)
    named = pairs.join(asked.select("qid", F.col("vec_id").alias("anchor_id"), "copies"), "qid")
    out = found.join(named, ["qid", "slot"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )

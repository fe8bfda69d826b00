"""MinHash fingerprints of whole texts, and near duplicates from their bands.

A text is its set of five-word shingles. ``PERMUTATIONS`` multiply-and-add hash functions, drawn from a universal family, order
all shingles, and the fingerprint keeps 16 bits of the smallest under each: two sets agree in a component with the chance of their
Jaccard similarity, so the share of equal components estimates it. All functions are worked out at once in numpy.

``near_duplicates`` cuts the fingerprint into bands. Texts that share a band are joined in Spark; groups that hang together by
such joins are cut into blocks, and every pair of blocks is verified by the exact Jaccard similarity in a task that holds two blocks. With 25
bands of 5 components a pair at a similarity of 0.8 shares a band with a chance of 0.9999.

``edited_fingerprints`` needs the start of the next text in order of the ids. Ids are cut into slices of some MB of text; the
first rows of a slice are also sent to the slice before, so texts are exchanged once and each slice is read in
order, row by row.

Defined cases: a null text counts as empty; texts with fewer words than five have one shingle, without words none; two empty
sets are alike (1), an empty one and another are not; null ids come last, and equal ids go by their text (a slice holds all rows of one id);
repeated rows follow each other; a single document is followed by itself; an empty table gives no rows; texts of any length are
hashed in blocks; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.llm.ngram_join import linked_sets, row_key
from trailmill.llm.shingling import mix, set_hash, shingle_sets
from trailmill.llm.storage import stored

WIDTH = 5
PERCENT = 80
PERMUTATIONS = 128
BANDS, BAND = 25, 5
#: Bytes of text in a slice of the ids.
SLICE = 8 << 20
#: Shingles that are hashed by all functions at once.
TOKENS = 512
_drawn = np.random.default_rng(23)
FACTORS = _drawn.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _drawn.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signature(tokens: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash under each function; all ones for an empty set."""
    if not len(tokens):
        return np.full(PERMUTATIONS, 0xFFFF, dtype=np.uint16)
    values = tokens >> np.uint64(32)
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), TOKENS):
        hashed = values[at : at + TOKENS, None] * FACTORS + OFFSETS
        np.minimum(least, hashed.min(axis=0), out=least)
    return mix(least).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / PERMUTATIONS


def text_of(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def signatures(column: pa.Array, width: int) -> list[np.ndarray]:
    return [signature(tokens) for tokens in shingle_sets(column, width)]


def sliced(docs: DataFrame, size: int) -> tuple[DataFrame, int]:
    """doc_id, text, slice and kind of every row, and the number of slices.

    Kind 0 is a row of the slice; kind 1 a copy of rows that begin the next slice; kind 2 a copy of the very first
    rows for the last slice. Slices begin at ids that exist, so a copy is told by its id.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bytes_, first = rows.agg(F.sum(F.octet_length("text").cast("long")), F.min(F.col("doc_id").cast("double"))).first()
    wanted = max(1, -(-(bytes_ or 0) // size))
    shares = [i / wanted for i in range(1, wanted)]
    found = rows.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", shares, 1 / (4 * wanted)) if shares else []
    begins = np.array(sorted(set(found) - {first}))
    if not len(begins):
        return rows.withColumns({"slice": F.lit(0), "kind": F.lit(0)}), 1
    sent, last = docs.sparkSession.sparkContext.broadcast(begins), len(begins)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), last, np.searchsorted(sent.value, ids.to_numpy(), side="right")))

    @F.pandas_udf("boolean")
    def begin(ids: pd.Series) -> pd.Series:
        return ids.isin(sent.value)

    number = F.col("doc_id").cast("double")
    own = F.struct(F.col("_at").alias("slice"), F.lit(0).alias("kind"))
    before = F.when(F.col("_begin"), F.struct((F.col("_at") - 1).alias("slice"), F.lit(1).alias("kind")))
    wrapped = F.when(number == first, F.struct(F.lit(last).alias("slice"), F.lit(2).alias("kind")))
    out = rows.withColumns({"_at": place(number), "_begin": begin(number)})
    out = out.select("doc_id", "text", F.explode(F.array_compact(F.array(own, before, wrapped))).alias("_s"))
    return out.select("doc_id", "text", "_s.slice", "_s.kind"), last + 1


class Follower:
    """Rows in order; each is finished by the text that follows it."""

    def __init__(self, width: int):
        self.width = width
        self.first = self.held = None
        self.done: list[tuple] = []

    def add(self, doc_id, text: str, print_: np.ndarray, own: bool) -> None:
        if self.held is not None:
            self.done.append((*self.held, text, print_))
        self.held = (doc_id, text, print_) if own else None
        if self.first is None:
            self.first = (text, print_)

    def close(self) -> None:
        """The last row of all is followed by the first."""
        if self.held is not None:
            self.done.append((*self.held, *self.first))
        self.held = None

    def rows(self, kind: pa.DataType) -> pa.RecordBatch:
        done, self.done = self.done, []
        edited = [text[: len(text) - len(text) // 4] + after[: len(text) // 4] for _, text, _, after, _ in done]
        prints = signatures(pa.array(edited, pa.string()), self.width) if done else []
        columns = {
            "doc_id": pa.array([r[0] for r in done], kind),
            "n_chars": pa.array([len(r[1]) for r in done], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array([text_of(r[2]) for r in done], pa.string()),
            "edited_fingerprint": pa.array([text_of(p) for p in prints], pa.string()),
            "near_edited": pa.array([likeness(r[2], p) for r, p in zip(done, prints, strict=True)], pa.float64()),
            "near_next": pa.array([likeness(r[2], r[4]) for r in done], pa.float64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def edited_fingerprints(docs: DataFrame, width: int = WIDTH, size: int = SLICE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    The edited text has its last quarter of code points replaced by as many from the start of the next text.
    """
    rows, slices = sliced(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        follower, at, kind = Follower(width), None, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for begin in range(0, batch.num_rows, 1_000):
                part = batch.slice(begin, 1_000)
                prints = signatures(part.column("text"), width)
                names = ("doc_id", "text", "slice", "kind")
                for doc_id, text, place, own, print_ in zip(*(part.column(c).to_pylist() for c in names), prints, strict=True):
                    if place != at:
                        follower.close()
                        follower.first, at = None, place
                    follower.add(doc_id, text, print_, own == 0)
                yield follower.rows(kind)
        if kind is not None:
            follower.close()
            yield follower.rows(kind)

    ordered = rows.repartitionById(slices, "slice").sortWithinPartitions("slice", "kind", F.asc_nulls_last("doc_id"), "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)


def band_rows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, row, node, n_shingles and keys (one per band) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for tokens in shingle_sets(batch.column("text"), width):
                nodes.append(set_hash(tokens))
                sizes.append(len(tokens))
                bands = signature(tokens)[: BANDS * BAND].reshape(BANDS, BAND).astype(np.uint64)
                total = np.arange(1, BANDS + 1, dtype=np.uint64)
                for c in bands.T:
                    total = mix(total + c * np.uint64(0x9E3779B97F4A7C15))
                keys.append(total.view(np.int64) if len(tokens) else np.zeros(0, dtype=np.int64))
            places = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(places, flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "node", "n_shingles", "keys"])

    rows = docs.select("doc_id", row_key().alias("row"), "text")
    return rows.mapInArrow(keyed, f"doc_id {kind}, row string, node long, n_shingles long, keys array<long>")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = 1_024) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by verified links of ``percent`` Jaccard) of every row."""
    rows = stored(band_rows(docs, width), "bands")
    return linked_sets(docs, rows, width, percent, block).select("doc_id", "n_shingles", "component_id")

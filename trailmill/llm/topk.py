"""Exact top-k inner products, term at a time.

Vectors become integer rows. Queries are cut into blocks of bounded size that are sent to the tasks which read the
candidates, so candidates are never exchanged. A task turns each chunk of its candidates into postings: for
each component the rows where it is not zero, and their weights. A query scatters its own non-zero
components, one after another, into a dense array of scores of the chunk; the best k are
partitioned out and join the best of the chunks before. A task returns k rows per query, and the lists of all tasks merge per query.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows with
a null id; a row is every other row's candidate but never its own, so rows that repeat id and vector find each
other and give their result once each; a missing component counts as 0; equal scores go by the smaller id; an empty table gives no
rows. Scores are exact while they fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmill.llm.vectors import Best, chunks, complete, dense_rows, padded, quantised, with_blocks

BLOCK = 8_192
FOUND = "qid long, vec_id long, score long"


def postings(block: np.ndarray) -> list[tuple]:
    """Per component the rows that hold it and their weights; a slice where all rows do."""
    out = []
    for column in block.T:
        rows = np.flatnonzero(column)
        out.append((slice(None), column.copy()) if len(rows) == len(column) else (rows, column[rows]))
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores but for ``own`` ones, equal ones by smaller id; ``ids`` rise."""
    keep = np.delete(np.arange(len(ids)), own)
    if len(keep) > k:
        floor = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
        above = keep[scores[keep] > floor]
        keep = np.concatenate([above, keep[scores[keep] == floor][: k - len(above)]])
    return keep


def scanned(queries, k: int, scale: float, block: int):
    """Best candidates of the rows of a task for a broadcast block of queries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, query_ids, asked = queries.value
        best = Best(len(qids), k)
        for batch in chunks(batches, block):
            kept, rows = dense_rows(batch.column("vector"), scale)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)[kept]
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], rows[order]
            if not len(ids):
                continue
            lists = postings(rows)
            scores = np.empty(len(ids), dtype=np.int64)
            found = []
            for slot, (query, weights) in enumerate(zip(query_ids, asked, strict=True)):
                scores[:] = 0
                for term in np.flatnonzero(weights[: len(lists)]):
                    at, values = lists[term]
                    scores[at] += weights[term] * values
                own = np.arange(*np.searchsorted(ids, [query, query + 1]))
                width = max(rows.shape[1], len(weights))
                own = own[(padded(rows[own], width) == padded(weights[None, :], width)).all(axis=1)]
                here = best_of(scores, ids, own, k)
                found.append((np.full(len(here), slot), ids[here], scores[here]))
            best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
        slots, ids, scores = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(qids[slots]), pa.array(ids), pa.array(scores)], ["qid", "vec_id", "score"])

    return scan


def top_k(
    vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = 256.0, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of all others for each row that ``queries`` (over vec_id) takes.

    Memory is a block of queries, a chunk of candidates and k rows per query; what tasks exchange is k rows
    per query and task.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where("vec_id is not null")
    asked = rows.where(queries).where(complete(F.col("vector"))).groupBy("vec_id", quantised(F.col("vector"), scale).alias("v"))
    asked, blocks = with_blocks(asked.agg(F.count(F.lit(1)).alias("copies")), "queries")
    found = asked.where("copies > 1").select(
        "qid", "vec_id", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("score"),
        F.explode(F.sequence(F.lit(1), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))),
    ).drop("col")
    for number in range(blocks):
        table = asked.where(F.col("block") == number).select("qid", "vec_id", F.col("v").cast("array<double>").alias("v")).toArrow()
        _, weights = dense_rows(table.column("v").combine_chunks(), 1.0)
        sent = spark.sparkContext.broadcast((table.column("qid").to_numpy(), table.column("vec_id").to_numpy(), weights))
        found = found.union(rows.mapInArrow(scanned(sent, k, scale, block), FOUND))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.select("qid", F.col("vec_id").alias("query_id"), "copies")
    out = ranked.join(names, "qid").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("query_id", "rank", "vec_id", "score")

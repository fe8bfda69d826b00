"""Centroid clustering of whole-number vectors with a vantage-point tree over the centroids.

Every round builds a tree over the centroids on the driver (k of them, whatever the data) and sends it to all tasks. A
node holds one centroid, its vantage point, and parts the other centroids below it at the median of their distances
to it; for each side it keeps the smallest and largest distance. A vector searches best first: of the nodes it
has not visited it takes that with the smallest bound, measures its own distance to the vantage point there in whole numbers,
and bounds both sides by the triangle inequality. A node is left out only if its bound is larger than the best
distance; one that could tie is visited, and ties go to the smaller number. All vectors of a batch take their steps together in numpy.

Tasks add up counts and components per centroid, so each returns k rows; the new centroids are exact
floors of the sums by the counts.

Defined cases: vectors that are null, of another width, or that hold null or non-finite components take no part; a null id takes part
but does not start a centroid; rows that repeat an id are vectors of their own, and equal hashes order by vector; with
fewer vectors than k there are as many centroids as vectors with an id, and without any no rows; an empty centroid
stays where it is. Distances are exact while they fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.llm.storage import stored
from trailmill.llm.vectors import chunks, complete, quantised

CHUNK = 8_192
#: Added to what a bound is compared with, as roots of whole numbers are rounded.
SLACK = 1e-6


@dataclass
class Tree:
    """Arrays by node: its centroid, its two children (-1: none) and the range of distances on either side."""

    point: np.ndarray
    child: np.ndarray
    near: np.ndarray
    far: np.ndarray


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, whole numbers."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def vantage_tree(centroids: np.ndarray) -> Tree:
    """A node per centroid; its vantage point is the one that lies farthest from the vantage point above."""
    size = len(centroids)
    tree = Tree(np.zeros(size, np.int64), np.full((size, 2), -1), np.zeros((size, 2)), np.zeros((size, 2)))
    made = 0

    def grown(members: np.ndarray, start: int) -> int:
        nonlocal made
        node, made = made, made + 1
        tree.point[node] = start
        rest = members[members != start]
        if len(rest):
            roots = np.sqrt(distance(centroids[rest], centroids[start]).astype(np.float64))
            middle = np.median(roots)
            for side, held in enumerate((roots <= middle, roots > middle)):
                if held.any():
                    tree.near[node, side], tree.far[node, side] = roots[held].min(), roots[held].max()
                    tree.child[node, side] = grown(rest[held], int(rest[held][roots[held].argmax()]))
        return node

    grown(np.arange(size), 0)
    return tree


def nearest(rows: np.ndarray, centroids: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each row, and how many distances were measured."""
    many = len(rows)
    bound = np.full((many, len(centroids)), np.inf)
    bound[:, 0] = 0.0
    best, number = np.full(many, np.iinfo(np.int64).max), np.full(many, len(centroids))
    open_rows, measured = np.arange(many), 0
    while len(open_rows):
        node = bound[open_rows].argmin(axis=1)
        least = bound[open_rows, node]
        going = least <= np.sqrt(best[open_rows].astype(np.float64)) + SLACK
        open_rows, node, least = open_rows[going], node[going], least[going]
        point = tree.point[node]
        squared = distance(rows[open_rows], centroids[point])
        measured += len(open_rows)
        closer = (squared < best[open_rows]) | ((squared == best[open_rows]) & (point < number[open_rows]))
        best[open_rows[closer]], number[open_rows[closer]] = squared[closer], point[closer]
        bound[open_rows, node] = np.inf
        root = np.sqrt(squared.astype(np.float64))
        for side in (0, 1):
            child = tree.child[node, side]
            has = child >= 0
            reach = np.maximum(root - tree.far[node, side], tree.near[node, side] - root)
            bound[open_rows[has], child[has]] = (np.maximum(least, reach) - SLACK * (1 + root))[has]
        open_rows = open_rows[np.isfinite(bound[open_rows]).any(axis=1)]
    return number, best, measured


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(sent, width: int):
    """Rows centroid, n and sums of the vectors of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = sent.value
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), width), np.int64)
        for batch in chunks(batches, CHUNK):
            rows = matrix(batch.column("v"), width)
            number = nearest(rows, centroids, tree)[0]
            counts += np.bincount(number, minlength=len(centroids))
            for c in np.unique(number):
                sums[c] += rows[number == c].sum(axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], ["c", "n", "sums"])

    return run


def assigned(sent, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, CHUNK):
            number, squared, _ = nearest(matrix(batch.column("v"), width), *sent.value)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(squared)], ["vec_id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.where("vec_id is not null").select(key.alias("key"), "v").orderBy("key", "v").limit(k)
    return np.array([r["v"] for r in sorted(first.collect())], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Centroids after one round: floors of the means of their vectors."""
    sent = rows.sparkSession.sparkContext.broadcast((centroids, vantage_tree(centroids)))
    parts = rows.select("v").mapInArrow(summed(sent, width), "c long, n long, sums array<long>")
    totals = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    out = centroids.copy()
    for c, n, sums in totals.collect():
        out[c] = [s // n for s in sums]
    return out


def clustered(
    vectors: DataFrame, k: int, rounds: int, width: int, scale: float, seed: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every complete vector."""
    vector = F.col(vector_col)
    usable = vectors.where((F.size(vector) == width) & complete(vector))
    rows = stored(usable.select(F.col(id_col).alias("vec_id"), quantised(vector, scale).alias("v")), "vectors")
    centroids = first_centroids(rows, k, seed)
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not len(centroids):
        blank = {"cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        none = spark.createDataFrame([], schema)
        return none.withColumns({c: F.lit(None).cast(t) for c, t in blank.items()})
    for _ in range(rounds):
        centroids = moved(rows, centroids, width)
    sent = spark.sparkContext.broadcast((centroids, vantage_tree(centroids)))
    found = stored(rows.mapInArrow(assigned(sent, width), schema), "clusters")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()
    whole = sum(r["n"] for r in sums)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(r["cluster"], r["n"], whole, digests[r["cluster"]]) for r in sums]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

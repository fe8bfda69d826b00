"""Language identification by nearest centroids.

A text becomes counts of hashed letter n-grams (1 to 3 letters, lower case, every run of other characters
one gap). Vectors are square-root counts times inverse document frequency, normalised. For each
language spherical k-means gives several centroids. A text gets the language of the centroid with the largest
cosine; it is marked as rejected where it is farther from it than nearly all training texts were.

Document frequencies are counted over all labelled rows. The centroids are fitted on a sample of about ``per_language``
labelled rows of each language, picked by a hash of the id: a documented bound of what reaches the driver.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without language or with a null id do not
train; with no training rows every text is ``und``; equal cosines go by the order of the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.tables import mapped

SIZE_BITS = 12
SIZE = 1 << SIZE_BITS
PER_LANGUAGE = 400
CENTROIDS = 3
ROUNDS = 10
BATCH = 256
FAR_QUANTILE = 0.995
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams, None where there is no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[codes]
    if not letters.any():
        return None
    after = np.concatenate([[False], letters[:-1]])
    line = np.where(letters, codes, 32)[letters | after].astype(np.uint64)
    line = np.concatenate([[np.uint64(32)], line, [np.uint64(32)]]).astype(np.uint64)
    mix, mask, shift = np.uint64(0x9E3779B1), np.uint64(0xFFFFFFFF), np.uint64(32 - SIZE_BITS)
    total = np.zeros(SIZE, dtype=np.int64)
    gram = line
    for n in range(3):
        if n:
            gram = (gram[:-1] * np.uint64(0x01000193) + line[n:]) & mask
        hashed = ((gram + np.uint64(n)) * mix & mask) >> shift
        total += np.bincount(hashed.astype(np.int64), minlength=SIZE)
    return total


def normalised(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    farthest: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return normalised(np.sqrt(counts) * self.idf)


def spherical_means(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids by k-means on the sphere, begun with the mean and then the farthest rows."""
    centres = normalised(rows.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(rows)):
        centres = np.vstack([centres, rows[np.argmin((rows @ centres.T).max(axis=1))]])
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centres.T, axis=1)
        centres = normalised(np.vstack([rows[own == i].mean(axis=0) if (own == i).any() else c for i, c in enumerate(centres)]))
    return centres


def frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents per n-gram bucket of this task; bucket -1 counts the documents."""
    held, seen = np.zeros(SIZE, dtype=np.int64), 0
    for frame in frames:
        for text in frame["text"]:
            counts = gram_counts(text)
            if counts is not None:
                held += counts > 0
                seen += 1
    yield pd.DataFrame({"bucket": np.arange(-1, SIZE), "n": np.concatenate([[seen], held])})


def sample_vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = [gram_counts(t) for t in frame["text"]]
        kept = [(str(i), lang, c.astype(np.int32)) for i, lang, c in zip(frame["doc_id"], frame["lang"], counts, strict=True) if c is not None]
        yield pd.DataFrame(kept, columns=["doc_id", "lang", "counts"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Model of the rows of ``labelled`` that have a text and a language."""
    rows = labelled.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = rows.select("text").mapInPandas(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    documents = {r["bucket"]: r["n"] for r in found}
    held = np.array([documents.get(i, 0) for i in range(SIZE)], dtype=np.float64)
    idf = np.log((1 + documents.get(-1, 0)) / (1 + held)) + 1
    if not sizes:
        return Model([], idf, np.zeros((0, SIZE)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < share[F.col("lang")]).mapInPandas(sample_vectors, "doc_id string, lang string, counts array<int>").toPandas()
    model = Model([], idf, np.zeros((0, SIZE)), np.zeros(0))
    for lang in sorted(sample["lang"].unique()):
        own = sample[sample["lang"] == lang].sort_values("doc_id")
        vectors = model.vectors(np.vstack(own["counts"].to_list()))
        means = spherical_means(vectors, centroids)
        best = (vectors @ means.T).max(axis=1)
        model.languages += [lang] * len(means)
        model.centroids = np.vstack([model.centroids, means])
        model.farthest = np.append(model.farthest, np.full(len(means), np.quantile(1 - best, FAR_QUANTILE)))
    return model


def classify(model: Model, texts) -> list[tuple[str, float, bool]]:
    """Language, cosine and rejection of each text."""
    counts = [gram_counts(t) for t in texts]
    filled = [i for i, c in enumerate(counts) if c is not None]
    out = [(UNKNOWN, 0.0, True)] * len(counts)
    for begin in range(0, len(filled) if model.languages else 0, BATCH):
        some = filled[begin : begin + BATCH]
        cosines = model.vectors(np.vstack([counts[i] for i in some])) @ model.centroids.T
        for i, row in zip(some, cosines, strict=True):
            at = int(np.argmax(row))
            score = float(min(1.0, max(0.0, row[at])))
            out[i] = (model.languages[at], score, bool(1 - score > model.farthest[at]))
    return out


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row, from its text alone."""

    def predict(texts: pa.Array) -> list:
        found = classify(model, texts.to_pylist())
        return [list(column) for column in zip(*found, strict=True)] or [[], [], []]

    added = {"lang_pred": "string", "score": "double", "rejected": "boolean"}
    return mapped(docs.select("doc_id", "text"), "text", predict, added)


def held_out(folds: int = 5) -> Column:
    """Whether a row belongs to the part that never trains; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))

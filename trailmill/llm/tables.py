"""Input tables and the word pattern that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
#: Java pattern of a run of blanks, that is of what separates two words.
BLANK_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and for blanks only."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) > 0, F.split(bare, BLANK_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    """Number of words, without an array of them: 0 for null and for blanks only.

    Words become one letter each and blanks go, so the length that is left counts them.
    """
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.length(F.ltrim(marked, F.lit(BLANKS))).cast("long")


TYPES = {
    "long": (T.LongType(), pa.int64()),
    "double": (T.DoubleType(), pa.float64()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "string": (T.StringType(), pa.string()),
    "binary": (T.BinaryType(), pa.binary()),
    "array<int>": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
}


def mapped(df: DataFrame, given: str, work: Callable[[pa.Array], list], added: dict[str, str]) -> DataFrame:
    """``df`` with the columns ``added`` (name to type) in place of ``given``; the other columns pass unread.

    ``work`` gets the column of an Arrow batch and returns one list per new column.
    """
    kept = [c for c in df.columns if c != given]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, TYPES[k][0]) for n, k in added.items()])
    kinds = [TYPES[k][1] for k in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = work(batch.column(given))
            arrays = [pa.array(v, type=k) for v, k in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], [*kept, *added])

    return df.mapInArrow(run, schema)

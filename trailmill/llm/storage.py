"""Tables between two jobs, written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trailmill.scale import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: lineage ends here, and columns are pruned from here on."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

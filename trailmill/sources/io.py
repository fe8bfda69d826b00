"""Readers and writers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmill import schema as S
from trailmill.functions import scalars


def read_clicks_csv(
    spark: SparkSession, path: str, columns: T.StructType = S.RAW_CLICKS
) -> DataFrame:
    """Raw click CSV with a declared schema; header names are replaced by position."""
    return (
        spark.read.schema(columns)
        .options(sep=";", header=True, enforceSchema=True, mode="FAILFAST")
        .csv(path)
    )


def read_clicks_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Raw click CSV with inferred types and snake-case headers (reads the file twice)."""
    raw = spark.read.options(sep=";", header=True, inferSchema=True).csv(path)
    return scalars.normalise_headers(raw)


def clean_clicks(raw: DataFrame) -> DataFrame:
    """Cleaned clicks: one date, text codes, a boolean price flag, integer country."""
    codes = ["category", "colour", "location", "photo_type"]
    return (
        raw.transform(scalars.with_click_date)
        .withColumns({c: F.col(c).cast("string") for c in codes})
        .withColumn("price_above_avg", scalars.above_average(F.col("price_2")))
        .drop("price_2")
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink; nested columns are written as JSON text, quotes doubled."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, escape='"')


def rows_frame(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A few literal rows (parameters, lookup entries) as a frame with a declared schema."""
    return spark.createDataFrame(rows, schema=columns)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metrics frame (track, model, metric, value) as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("track string, model string, metric string, value double").json(path)


def nested_metrics(metrics: DataFrame) -> DataFrame:
    """One row per track with a JSON object {model: {metric: value}}."""
    per_model = metrics.groupBy("track", "model").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("values")
    )
    return per_model.groupBy("track").agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", F.to_json("values")))))
        ).alias("models")
    )


def save_model(model: Any, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_fit(kind: type[MLReadable], path: str, fit) -> Any:
    """Load a saved model; fit and save it when the folder holds none."""
    spark = SparkSession.active()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/metadata")
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(folder):
        return kind.load(path)
    model = fit()
    save_model(model, path)
    return model


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def described(df: DataFrame, rows: int = 5) -> DataFrame:
    """One row per column with its type, the number of rows, and its value in the first of the previewed rows."""
    total = df.count()
    first = preview(df, rows).limit(1)
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.lit(kind).alias("kind"), F.col(name).cast("string").alias("first_value"))
            for name, kind in schema_rows(df)
        ]
    )
    listed = first.select(F.inline(entries))
    return listed.select("column", "kind", F.lit(total).cast("long").alias("rows"), "first_value")


def write_document(metrics: DataFrame, top_items: DataFrame, params: dict[str, dict[str, float]], path: str) -> None:
    """One JSON document: metrics by track and model, the top items with their views, and the parameters of the models.

    ``metrics`` has a few rows per model, ``top_items`` (item_id, views) as many as the report shows.
    """
    per_track = nested_metrics(metrics).select("track", F.from_json("models", "map<string,string>").alias("models"))
    typed = F.transform_values("models", lambda _, v: F.from_json(v, "map<string,double>"))
    sections = per_track.agg(F.map_from_entries(F.collect_list(F.struct("track", typed.alias("models")))).alias("metrics"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("views")).alias("_order"), "item_id", "views"))), lambda s: s.dropFields("_order"))
    known = F.from_json(F.lit(json.dumps(params)), "map<string,map<string,double>>")
    top = top_items.agg(listed.alias("top_items")).withColumn("_one", F.lit(1))
    document = sections.withColumn("_one", F.lit(1)).join(top, "_one").drop("_one").withColumn("params", known)
    document.coalesce(1).write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The document as (section, owner, name, value) rows."""
    schema = (
        "metrics map<string,map<string,map<string,double>>>, top_items array<struct<item_id:string,views:long>>, params map<string,map<string,double>>"
    )
    document = spark.read.schema(schema).json(path)
    metrics = (
        document.select(F.explode("metrics").alias("track", "models")).select("track", F.explode("models").alias("model", "values"))
        .select(F.lit("metrics").alias("section"), F.concat_ws("/", "track", "model").alias("owner"), F.explode("values").alias("name", "value"))
    )
    top = document.select(F.posexplode("top_items").alias("at", "i")).select(
        F.lit("top_items").alias("section"), (F.col("at") + 1).cast("string").alias("owner"), F.col("i.item_id").alias("name"), F.col("i.views").cast("double").alias("value")
    )
    params = document.select(F.explode("params").alias("owner", "values")).select(
        F.lit("params").alias("section"), "owner", F.explode("values").alias("name", "value")
    )
    return metrics.union(top).union(params)

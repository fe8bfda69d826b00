"""Views over the driver's tables: clicks from ``events``, baskets from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmill.scale import BROADCAST_ROWS, bounded_side, dense_position, has_at_most

SESSION_GAP_US = 86_400_000_000
#: More sessions than a user can have, as they are a day apart; ids of two users never meet.
SESSIONS_A_USER = 1_000_000_000
MINUTE_US = 60_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def click_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-level columns of a click; no session, hence no shuffle."""
    item_no = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        (F.col("user_id") % 47 + 1).cast("int").alias("country"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("K"), item_no.cast("string")).alias("item_id"),
        item_no.alias("item_no"),
        (item_no % 14 + 1).cast("int").alias("colour"),
        (item_no % 6 + 1).cast("int").alias("location"),
        (item_no % 2 + 1).cast("int").alias("photo_type"),
        F.col("value").alias("price"),
        F.col("ts").cast("date").alias("click_date"),
    )


def clicks(spark: SparkSession, sf_dir: str, premium: bool = False) -> DataFrame:
    """Clicks with sessions: a user's events split where the gap exceeds 24 hours.

    A session cannot break inside one minute, so breaks and click offsets are worked
    out on one row per (user, minute) and joined back on that pair. A user with a
    large share of all events is thereby spread over as many groups as minutes.
    """
    facts = click_facts(spark, sf_dir).withColumn("minute", F.floor(F.col("us") / MINUTE_US))
    by_user = Window.partitionBy("user_id").orderBy("minute")
    before = Window.partitionBy("user_id", "session_no").orderBy("minute").rowsBetween(
        Window.unboundedPreceding, -1
    )
    gap = F.col("first_us") - F.lag("last_us").over(by_user)
    minutes = (
        facts.groupBy("user_id", "minute")
        .agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
        .withColumn("starts", F.when(gap <= SESSION_GAP_US, 0).otherwise(1))
        .withColumn("session_no", F.sum("starts").over(by_user))
        .withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("user_id", "minute", "session_no", "earlier")
    )
    in_minute = Window.partitionBy("user_id", "minute").orderBy("us", "event_id")
    order = (F.col("earlier") + F.row_number().over(in_minute)).cast("int")
    out = (
        facts.join(minutes, ["user_id", "minute"])
        .withColumn("click_order", order)
        .select(
            (F.col("user_id").cast("long") * SESSIONS_A_USER + F.col("session_no")).alias("session_id"),
            "click_order",
            "country",
            "category",
            "item_id",
            "item_no",
            "colour",
            "location",
            "photo_type",
            "price",
            F.least(F.lit(5), F.floor((F.col("click_order") - 1) / 4) + 1).cast("int").alias("page"),
            "click_date",
        )
    )
    if not premium:
        return out
    averages = facts.groupBy("category").agg(F.avg("price").alias("category_mean"))
    return (
        out.join(bounded_side(averages), "category")
        .withColumn("price_above_avg", F.col("price") > F.col("category_mean"))
        .drop("category_mean")
    )


def looked_up(side: DataFrame) -> DataFrame:
    """A lookup side: broadcast while it is small, else a hash table per partition, so that the rows that meet it are not sorted."""
    return F.broadcast(side) if has_at_most(side, BROADCAST_ROWS) else side.hint("shuffle_hash")


def baskets(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    """Orders as sessions, order lines as clicks."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    if positions:
        lines = dense_position(
            lines,
            ["l_orderkey"],
            ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"],
            F.to_date("l_shipdate"),
            out="click_order",
        ).withColumn("click_order", F.col("click_order").cast("int"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
    order = ["click_order"] if positions else []
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(looked_up(customer), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(looked_up(part), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("session_id"),
            *order,
            F.col("c_nationkey").alias("country"),
            F.col("r_name").alias("region"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("colour"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_retailprice").alias("price"),
            F.col("l_linenumber").alias("page"),
            F.to_date("o_orderdate").alias("click_date"),
        )
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given vectors as arrays of doubles, with their labels as cluster ids."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").alias("cluster")
    )

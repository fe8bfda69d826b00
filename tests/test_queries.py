"""Every query with SQL gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as contract
from check_queries import compare, connect, normal
from trailmill import scale

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    mine = normal(frame.columns, [tuple(r) for r in frame.collect()])
    found = db.execute(SQL[name])
    theirs = normal([d[0] for d in found.description], found.fetchall())
    assert compare(mine, theirs) == ""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["item_similarity", "price_summary", "popularity_recs"])
def test_partition_count_does_not_matter(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            frame = contract.queries()[name](spark, SF_DIR)
            results.append(normal(frame.columns, [tuple(r) for r in frame.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


LARGE_SIDES = ["components", "item_similarity", "knn_recs", "label_prop_3", "markov_recs", "pagerank_5", "prefix_pool",
               "session_summary", "tfidf_long", "tokenised_clicks", "transitions", "triangles", "davies_bouldin"]


@pytest.mark.parametrize("name", LARGE_SIDES)
def test_sides_too_large_to_broadcast(spark, db, monkeypatch, name):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        test_matches_sql(spark, db, name)
    finally:
        for limit in limits:
            spark.conf.unset(limit)
        spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")

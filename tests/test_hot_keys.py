"""Split and blocked paths give what the plain computation gives."""

import random
import tracemalloc
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trailmill import plans, scale
from trailmill.operators import catalogue, cooccurrence, factors, graph, pooling, recommend, retrieval, rules, sequences
from trailmill.operators.cooccurrence import pair_sums
from trailmill.plans import model_queries
from trailmill.scale import materialise


def same(left, right):
    order = sorted(left.columns)
    assert sorted(right.columns) == order
    a = sorted((tuple(r) for r in left.select(order).collect()), key=repr)
    b = sorted((tuple(r) for r in right.select(order).collect()), key=repr)
    assert a == b and a


@pytest.fixture(scope="module")
def skewed(spark):
    """One session with most of the clicks next to many short ones."""
    rng = random.Random(7)
    rows = [(0, i, rng.randrange(40)) for i in range(1, 801)]
    for s in range(1, 60):
        rows += [(s, i, rng.randrange(40)) for i in range(1, rng.randrange(2, 9))]
    df = spark.createDataFrame(rows, "session_id long, click_order int, item_idx int")
    return scale.materialise(df)


def session_order():
    return Window.partitionBy("session_id").orderBy("click_order")



@pytest.mark.parametrize("ahead", [1, 3])
@pytest.mark.parametrize("span", [3, 50, 10_000])
def test_next_across_spans(skewed, ahead, span):
    got = scale.with_next(skewed, ["session_id"], "click_order", {"next": "item_idx"}, ahead, span)
    same(got, skewed.withColumn("next", F.lead("item_idx", ahead).over(session_order())))


def test_dense_position_with_gaps(skewed):
    gaps = skewed.filter(F.col("click_order") % 5 != 0)
    got = scale.dense_position(gaps, ["session_id"], ["click_order"], scale.span_of("click_order", 7))
    same(got, gaps.withColumn("position", F.row_number().over(session_order()).cast("long")))


def test_running_totals_over_slices(skewed):
    got = scale.running_totals(
        skewed, ["click_order"], {"n": F.lit(1).cast("long"), "total": "item_idx"}, ["session_id"]
    )
    rows = session_order().rowsBetween(Window.unboundedPreceding, 0)
    same(got, skewed.withColumns({"n": F.count(F.lit(1)).over(rows), "total": F.sum("item_idx").over(rows)}))


def test_running_totals_really_use_several_slices(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scale.running_totals(skewed.filter("session_id = 0"), [F.desc("click_order")], {"n": F.lit(1)})
        assert got.filter(F.col("n") != 801 - F.col("click_order")).count() == 0
        assert got.count() == 800
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_percentiles_of_groups(skewed):
    points = {"low": 0.05, "mid": 0.5, "high": 0.95}
    got = scale.exact_percentiles(skewed, "item_idx", points, ["session_id"])
    plain = skewed.groupBy("session_id").agg(*[F.percentile("item_idx", p).alias(n) for n, p in points.items()])
    digits = [F.round(n, 9).alias(n) for n in points]
    same(got.select("session_id", *digits), plain.select("session_id", *digits))


def test_bounded_side_hints_only_small_sides(spark):
    def hint(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hint(scale.bounded_side(spark.range(5), max_rows=5))
    assert not hint(scale.bounded_side(spark.range(6), max_rows=5))


def test_sequences_in_segments(skewed):
    parts = sequences.session_sequences(skewed, "item_idx", span=64)
    assert parts.agg(F.max(F.size("sequence"))).first()[0] == 64
    back = parts.select("session_id", "segment", F.posexplode("sequence").alias("i", "item_idx"))
    back = back.select("session_id", (F.col("segment") * 64 + F.col("i") + 1).cast("int").alias("click_order"), "item_idx")
    same(back, skewed)


def test_prefixes_in_segments(skewed):
    short = skewed.filter("click_order <= 30")
    parts = sequences.prefix_sequences(short, "item_idx", span=8)
    whole = parts.groupBy("session_id", "click_order", "next").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("segment", "prefix"))), lambda p: p["prefix"])).alias("prefix")
    )
    same(whole, sequences.prefix_sequences(short, "item_idx").drop("segment"))


def pairs_by_join(entries):
    a = entries.select("session_id", F.col("item_idx").alias("item_a"), F.col("w").alias("wa"))
    b = entries.select("session_id", F.col("item_idx").alias("item_b"), F.col("w").alias("wb"))
    return (
        a.join(b, "session_id").filter("item_a < item_b")
        .groupBy("item_a", "item_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("total"))
    )


@pytest.mark.parametrize("tile", [4, 512])
def test_pair_sums_of_a_wide_session(skewed, tile):
    entries = skewed.groupBy("session_id", "item_idx").agg(F.count(F.lit(1)).alias("w"))
    same(pair_sums(entries, "item_idx", "w", tile=tile), pairs_by_join(entries))


def test_pair_sums_in_slices(skewed, monkeypatch):
    from trailmill.operators import cooccurrence

    entries = skewed.groupBy("session_id", "item_idx").agg(F.count(F.lit(1)).alias("w")).toPandas()
    lists = entries.groupby("session_id").agg(list)
    empty = [np.array([]) for _ in range(len(lists))]
    import pandas as pd

    batch = pd.DataFrame(
        {
            "_group": 0,
            "left_items": [np.array(x) for x in lists["item_idx"]],
            "left_w": [np.array(x) for x in lists["w"]],
            "right_items": empty,
            "right_w": empty,
        }
    )
    whole = cooccurrence.merge_pairs(list(cooccurrence.batch_pairs(batch)))
    monkeypatch.setattr(cooccurrence, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(cooccurrence, "FLUSH_ROWS", 100)
    parts = cooccurrence.merge_pairs(list(cooccurrence.combine_pairs(iter([batch, batch]))))
    key = ["item_a", "item_b"]
    left = whole.sort_values(key)["total"].to_numpy() * 2
    assert (left == parts.sort_values(key)["total"].to_numpy()).all()


@pytest.mark.parametrize("k", [1, 5, 60])
def test_top_unseen_is_the_plain_anti_join(spark, skewed, k):
    train = skewed.groupBy("session_id", "item_idx").agg(F.count(F.lit(1)).alias("click_count"))
    popular = train.groupBy("item_idx").agg(F.sum("click_count").cast("double").alias("score"))
    sessions = train.select("session_id").distinct()
    seen = train.filter("session_id % 3 != 1")
    plain = recommend.exclude_seen(sessions.crossJoin(popular), seen, k)
    same(recommend.popularity_recs(sessions, train, seen, k), plain)


def unit_rows(n, size, seed):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=size)]) for i in range(n)]


@pytest.mark.parametrize("block", [7, 1000])
def test_nearest_items_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "ITEMS_PER_BLOCK", block)
    monkeypatch.setattr(retrieval, "QUERIES_PER_CHUNK", 9)
    items, queries = unit_rows(40, 6, 1), unit_rows(25, 6, 2)
    got = retrieval.nearest_items(
        spark.createDataFrame([(i, v, i % 3) for i, v in queries], "session_id long, vector array<double>, n_skip long"),
        spark.createDataFrame(items, "item_idx int, vector array<double>"),
        ["session_id"],
        k=4,
    )
    found = {}
    for r in got.collect():
        found.setdefault(r.session_id, set()).add(r.item_idx)
    for i, v in queries:
        order = sorted(range(40), key=lambda j: -float(np.dot(v, items[j][1])))
        assert found[i] == set(order[: 4 + i % 3])


def test_zero_query_takes_items_in_order(spark):
    got = retrieval.cosine_recs(
        spark.createDataFrame([(1, [0.0, 0.0])], "session_id long, vector array<double>"),
        spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "item_idx int, vector array<double>"),
        spark.createDataFrame([(1, 0)], "session_id long, item_idx int"),
        k=3,
    )
    assert sorted((r["rank"], r.item_idx, r.score) for r in got.collect()) == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]


def test_lsh_finds_the_best_of_the_shared_buckets(spark):
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector

    items = spark.createDataFrame(unit_rows(60, 8, 3), "item_idx int, vector array<double>")
    queries = spark.createDataFrame(unit_rows(20, 8, 4), "session_id long, vector array<double>")
    got = retrieval.lsh_recs(queries, items, ["session_id"], k=5, bucket=0.3, tables=2, threshold=1.3)

    def ready(df):
        vectors = df.withColumn("raw", array_to_vector("vector"))
        return Normalizer(inputCol="raw", outputCol="features").transform(vectors)

    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=0.3, numHashTables=2, seed=42
    ).fit(ready(items))
    joined = model.approxSimilarityJoin(ready(queries), ready(items), 1.3, "distance")
    w = Window.partitionBy("session_id").orderBy("distance", "item_idx")
    plain = (
        joined.select(
            F.col("datasetA.session_id").alias("session_id"), F.col("datasetB.item_idx").alias("item_idx"),
            F.round("distance", 9).alias("distance"),
        )
        .withColumn("rank", F.row_number().over(w)).filter("rank <= 5")
    )
    same(got.drop("distance"), plain.drop("distance"))


@pytest.mark.parametrize("tile", [3, 1000])
def test_fold_in_solves_the_normal_equations(spark, skewed, tile):
    size, alpha, reg = 4, 80.0, 0.1
    items = unit_rows(40, size, 5)
    y = np.array([v for _, v in items])
    history = skewed.groupBy("session_id", "item_idx").agg(F.count(F.lit(1)).alias("click_count"))
    got = factors.fold_in(history, spark.createDataFrame(items, "item_idx int, vector array<double>"), tile=tile)
    found = {r.session_id: r.vector for r in got.collect()}
    plain = {}
    for r in history.collect():
        plain.setdefault(r.session_id, []).append((r.item_idx, r.click_count))
    assert set(found) == set(plain)
    for session, entries in plain.items():
        a, b = y.T @ y + reg * np.eye(size), np.zeros(size)
        for item, n in entries:
            a += alpha * n * np.outer(y[item], y[item])
            b += (1 + alpha * n) * y[item]
        assert np.allclose(found[session], np.linalg.solve(a, b), atol=1e-8)


@pytest.mark.parametrize("decay", [0.01, 0.5, 1.0])
@pytest.mark.parametrize("span", [16, 10_000])
def test_prefix_pool_over_spans(spark, skewed, decay, span):
    items = unit_rows(35, 3, 6)  # items 35 to 39 have no vector
    vectors = spark.createDataFrame(items, "item_idx int, vector array<double>")
    got = pooling.prefix_pool(skewed, vectors, decay, "item_idx", span=span)
    found = {(r.session_id, r.click_order): (r.next, r.vector) for r in got.collect()}
    known = dict(items)
    sessions = {}
    for r in skewed.orderBy("click_order").collect():
        sessions.setdefault(r.session_id, []).append(r.item_idx)
    checked = 0
    for session, path in sessions.items():
        first = {}
        for t, item in enumerate(path, 1):
            first.setdefault(item, t)
            used = [i for i in path[:t] if i in known]
            if t == len(path) or not used:
                assert (session, t) not in found
                continue
            newest = max(first[i] for i in used)  # common factors cancel in the mean
            weights = np.array([decay ** (newest - first[i]) for i in used])
            expected = weights @ np.array([known[i] for i in used]) / weights.sum()
            nxt, vector = found[(session, t)]
            assert nxt == path[t] and np.allclose(vector, expected, atol=1e-9)
            checked += 1
    assert checked == len(found) > 800


def random_path(spark, seed=3, sessions=30, items=40):
    rng = np.random.default_rng(seed)
    rows = [(s, t, int(rng.integers(items))) for s in range(sessions) for t in range(1, int(rng.integers(2, 25)))]
    return spark.createDataFrame(rows, "session_id long, click_order int, item_idx int")


@pytest.mark.parametrize("name", ["cosine", "prefix", "last", "decayed", "ranks", "lsh"])
def test_a_catalogue_too_large_to_send_gives_the_same(spark, monkeypatch, name):
    clicks = materialise(random_path(spark))
    vectors = spark.createDataFrame(unit_rows(35, 6, 1), "item_idx int, vector array<double>")
    queries = spark.createDataFrame(unit_rows(30, 6, 2), "session_id long, vector array<double>")

    def run():
        prefixes = lambda: pooling.prefix_pool(clicks, vectors, 0.3, "item_idx")
        if name == "cosine":
            return retrieval.cosine_recs(queries, vectors, clicks, 4)
        if name == "lsh":
            return retrieval.lsh_recs(queries, vectors, ["session_id"], k=4, bucket=0.4, directions=retrieval.random_directions(3, 6, 1))
        if name == "ranks":
            return retrieval.next_ranks(prefixes(), vectors)
        long = {"prefix": prefixes, "last": lambda: pooling.last_prefix_pool(clicks, vectors, 0.3, "item_idx"),
                "decayed": lambda: pooling.decayed_pool(clicks, vectors, 0.8, "item_idx")}[name]()
        return long.withColumn("vector", F.transform("vector", lambda x: F.round(x, 9)))

    sent = sorted(map(str, run().collect()))
    monkeypatch.setattr(catalogue, "SENT_BYTES", 900)
    monkeypatch.setattr(retrieval, "ITEMS_PER_BLOCK", 9)
    monkeypatch.setattr(retrieval, "QUERIES_PER_CHUNK", 7)
    assert len(sent) > 20 and sorted(map(str, run().collect())) == sent


def test_a_catalogue_in_parts_copies_no_queries(spark, monkeypatch):
    queries = spark.createDataFrame(unit_rows(30, 6, 2), "session_id long, vector array<double>")
    seen = materialise(random_path(spark))
    known = unit_rows(35, 6, 1)
    once, twice = (spark.createDataFrame(rows, "item_idx int, vector array<double>") for rows in (known, [*known, *known[:4]]))
    sent = sorted(map(str, retrieval.cosine_recs(queries, once, seen, 4).collect()))
    monkeypatch.setattr(catalogue, "SENT_BYTES", 900)
    monkeypatch.setattr(retrieval, "ITEMS_PER_BLOCK", 9)
    repeated = sorted(map(str, retrieval.cosine_recs(queries, twice, seen, 4).collect()))

    def copied(*_):
        raise AssertionError("queries were copied to every block of items")

    monkeypatch.setattr(retrieval, "nearest_items", copied)
    assert sorted(map(str, retrieval.cosine_recs(queries, once, seen, 4).collect())) == sent == repeated


def test_a_scan_keeps_its_number_of_tasks(spark):
    queries = spark.createDataFrame(unit_rows(30, 6, 2), "session_id long, vector array<double>")
    items = spark.createDataFrame(unit_rows(35, 6, 1), "item_idx int, vector array<double>")
    recs = retrieval.cosine_recs(queries, items, random_path(spark), 4)
    assert recs.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_pair_sums_hold_little_at_once():
    rng = np.random.default_rng(3)
    baskets = [np.sort(rng.choice(60_000, 25, replace=False)) for _ in range(4_000)]
    batch = pd.DataFrame({"_group": ["a"] * len(baskets), "left_items": baskets, "left_w": [np.ones(25, np.int64)] * len(baskets),
                          "right_items": [b[:0] for b in baskets], "right_w": [np.ones(0, np.int64)] * len(baskets)})
    tracemalloc.start()
    total = sum(int(part["total"].sum()) for part in cooccurrence.combine_pairs(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(baskets) * 25 * 24 // 2
    assert peak < 120 << 20


@pytest.mark.parametrize("repeated", [False, True])
def test_mean_pool_over_null_sessions_repeated_items_and_null_vectors(spark, repeated):
    rng = np.random.default_rng(5)
    rows = [(None if s == 0 else s, f"I{i}") for s, i in zip(rng.integers(0, 9, 300).tolist(), rng.integers(0, 25, 300).tolist())]
    known = [(f"I{i}", v) for i, v in unit_rows(20, 4, 1)]
    known += known[:3] if repeated else []
    vectors = spark.createDataFrame([*known, ("I24", None), (None, [1.0] * 4)], "item_id string, vector array<double>")
    got = pooling.mean_pool(spark.createDataFrame(rows, "session_id long, item_id string"), vectors).collect()
    want = {}
    for s, i in rows:
        want.setdefault(s, []).extend(v for item, v in known if item == i)
    assert {r.session_id for r in got} == {s for s, v in want.items() if v}
    for r in got:
        mean = np.mean(want[r.session_id], axis=0)
        assert np.allclose(r.pooled, mean) and np.allclose(r.unit, mean / np.linalg.norm(mean))


def test_session_clusters_reads_the_clicks_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(s, o, f"K{i}", i, 1, 1, 1, 1, 2.0, 1, "view", date(2024, 1, 1)) for s in range(40) for o, i in enumerate(rng.integers(0, 6, 9).tolist(), 1)]
    columns = "session_id long, click_order int, item_id string, item_no int, country int, colour int, location int, photo_type int, price double, page int, category string, click_date date"
    calls = []

    def found(*_):
        calls.append(1)
        return spark.createDataFrame(rows, columns)

    monkeypatch.setattr(model_queries, "clicks", found)
    plans.all_queries()["session_clusters"](spark, "none").collect()
    assert len(calls) == 1


def test_last_prefix_is_the_last_row_of_all_prefixes(spark):
    clicks = materialise(random_path(spark, 5))
    vectors = spark.createDataFrame(unit_rows(35, 4, 1), "item_idx int, vector array<double>")
    every = {}
    for r in pooling.prefix_pool(clicks, vectors, 0.2, "item_idx").orderBy("click_order").collect():
        every[r.session_id] = r.vector
    last = {r.session_id: r.vector for r in pooling.last_prefix_pool(clicks, vectors, 0.2, "item_idx").collect()}
    assert set(last) == set(every) and all(np.allclose(last[s], every[s]) for s in last)


def test_blocks_are_left_out_without_loss():
    rng = np.random.default_rng(7)
    items = rng.normal(size=(500, 5)) * rng.choice([0.1, 1.0, 30.0], size=(500, 1))
    known = catalogue.Catalogue(np.arange(500), items.copy(), block=16)
    queries = rng.normal(size=(40, 5))
    barred = np.repeat(np.arange(40), 3), known.positions(rng.integers(0, 500, 120))
    rows, ids, scores = catalogue.best(known, queries, 6, barred)
    full = np.round(queries @ items.T, 9)
    full[barred[0], known.ids[barred[1]]] = -np.inf
    for q in range(40):
        order = sorted(range(500), key=lambda i: (-full[q, i], i))[:6]
        assert ids[rows == q].tolist() == order and np.allclose(scores[rows == q], full[q, order])
    wanted = rng.integers(0, 520, 40)
    plain = np.round(queries @ items.T, 9)
    ranks = catalogue.ranks_of(known, queries, wanted)
    for q, w in enumerate(wanted):
        assert ranks[q] == (0 if w >= 500 else 1 + sum((-plain[q, i], i) < (-plain[q, w], w) for i in range(500)))


@pytest.mark.parametrize("rows", [5, 10_000])
def test_lsh_scores_a_pair_once(spark, monkeypatch, rows):
    monkeypatch.setattr(catalogue, "SENT_BYTES", 0)
    monkeypatch.setattr(retrieval, "ITEMS_PER_BLOCK", rows)
    items, queries = unit_rows(30, 4, 3), unit_rows(12, 4, 4)
    directions = retrieval.random_directions(4, 4, 2)
    got = retrieval.lsh_recs(
        spark.createDataFrame(queries, "session_id long, vector array<double>"), spark.createDataFrame(items, "item_idx int, vector array<double>"),
        ["session_id"], k=50, bucket=0.7, threshold=2.0, directions=directions,
    ).collect()
    unit_of = lambda v: np.array(v) / np.linalg.norm(v)
    want = set()
    for q, v in queries:
        for i, w in items:
            a, b = (np.floor(directions @ unit_of(x) / 0.7) for x in (v, w))
            if (a == b).any():
                want.add((q, i))
    assert sorted((r.session_id, r.item_idx) for r in got) == sorted(want)


def test_links_move_once(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = [(0, i) for i in range(1, 200)] + [(i, i % 7) for i in range(1, 200)]
        links = graph.Links(spark.createDataFrame(edges, "src long, dst long"), 200)
        assert [r.src for r in links.spread.select("src").distinct().collect()] == [0]  # the hub stays spread out
        values = links.by_id(spark.range(200).withColumn("rank", F.lit(1.0)))
        round_ = links.joined(values).groupBy(F.col("dst").alias("id")).agg(F.sum("rank").alias("rank"))
        again = links.joined(values.select("id").join(round_, "id", "left"))
        plan = again._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "ENSURE_REQUIREMENTS" in line]
        assert moved and all("hashpartitioning(dst" in line for line in moved), plan
        assert again.count() == len(edges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_and_labels_do_not_depend_on_the_path(spark, monkeypatch):
    rng = random.Random(5)
    edges = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(150)} | {(0, i) for i in range(1, 40)})
    edges = spark.createDataFrame([e for e in edges if e[0] != e[1]], "src long, dst long")
    vertices = spark.range(40)
    run = lambda: (
        [(r.id, round(r["rank"], 9)) for r in graph.pagerank(vertices, edges, 23).orderBy("id").collect()],
        [tuple(r) for r in graph.label_propagation(vertices, edges, 6).orderBy("id").collect()],
    )
    small = run()
    monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)
    assert run() == small


@pytest.mark.parametrize("min_pairs", [1, 3])
def test_bitmap_and_listed_pairs_agree(spark, monkeypatch, min_pairs):
    rng = random.Random(9)
    rows = [(s % 3, s, rng.choice("ABCDEFGHIJ") if rng.random() < 0.9 else None) for s in range(120) for _ in range(rng.randrange(1, 7))]
    clicks = spark.createDataFrame([(f"g{g}", s, i) for g, s, i in rows], "region string, session_id long, item_id string")
    run = lambda: rules.pair_rules(clicks, "item_id", "region", min_pairs)
    maps = run()
    found = sorted(map(tuple, maps.collect()))
    monkeypatch.setattr(rules, "BITS", 3)
    assert found and sorted(map(tuple, run().collect())) == found
    every = rules.pair_rules(clicks, "item_id", "region")
    assert sorted(map(tuple, rules.rule_between(every, "C", "B").collect())) == sorted(map(tuple, rules.rule_of_two(clicks, "item_id", "region", "C", "B").collect()))
    assert sorted(map(tuple, rules.rules_of(every, "region", "g1").collect())) == sorted(map(tuple, rules.rules_within(clicks, "item_id", "region", "g1").collect()))


def test_items_may_be_names(spark):
    clicks = materialise(random_path(spark, 8).withColumn("name", F.concat(F.lit("K"), F.col("item_idx").cast("string"))))
    vectors = spark.createDataFrame(unit_rows(35, 4, 1), "item_idx int, vector array<double>")
    named = vectors.withColumn("name", F.concat(F.lit("K"), F.col("item_idx").cast("string")))
    rounded = lambda df: sorted(str((r[0], [round(x, 9) for x in r["vector"]])) for r in df.collect())
    for pool in (pooling.decayed_pool, pooling.last_prefix_pool, pooling.prefix_pool):
        assert rounded(pool(clicks, named, 0.3, "name")) == rounded(pool(clicks, vectors, 0.3, "item_idx"))


def test_lists_of_single_queries_are_ranked_without_an_exchange(spark):
    """Equal rows, ties by item number, ids that are null; the lists of all queries were exchanged before."""
    rnd = np.random.default_rng(4)
    vector = lambda: rnd.integers(-3, 4, 6).astype(float).tolist()
    items = spark.createDataFrame([(i, vector()) for i in range(60)], "item_idx int, vector array<double>")
    ids = [None, *range(79)]
    queries = spark.createDataFrame([(i, vector()) for i in ids] + [(100, None)], "session_id long, vector array<double>")
    directions = retrieval.random_directions(3, 6, 1)

    def found(unique):
        return retrieval.lsh_recs(queries, items, ["session_id"], k=4, bucket=0.4, directions=directions, unique_ids=unique)

    rows = [sorted(map(tuple, found(u).collect()), key=str) for u in (False, True)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
    assert found(True).schema.simpleString() == found(False).schema.simpleString()
    assert "Exchange" not in found(True)._jdf.queryExecution().executedPlan().toString()


def test_unit_rows_equal_those_of_the_column(spark):
    from trailmill.functions.arrays import unit
    from trailmill.operators import catalogue

    rnd = np.random.default_rng(5)
    rows = [*(rnd.normal(size=9) * 10.0 ** rnd.integers(-160, 160) for _ in range(200)), np.zeros(9), np.full(9, np.inf), np.full(9, np.nan)]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "i int, vector array<double>")
    want = np.array([r["u"] for r in df.select("i", unit(F.col("vector")).alias("u")).orderBy("i").collect()])
    assert np.array_equal(catalogue.units(np.array(rows)), want, equal_nan=True)


def test_few_hits_are_found_in_order():
    rnd = np.random.default_rng(6)
    for shape, share in (((3, 5), 0.5), ((40, 1_024), 0.001), ((7, 13), 0.0), ((1, 8), 1.0), ((0, 4), 0.0)):
        hits = rnd.random(shape) < share
        assert catalogue.places_set(hits).tolist() == np.flatnonzero(hits).tolist()

"""Steps that must not grow faster than their input."""

from __future__ import annotations

from threading import Event
from types import SimpleNamespace

import numpy as np
import pytest

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from trailmill.functions.arrays import unit
from trailmill.operators import catalogue, clusters, evaluate, explore, features, topics
from trailmill.plans.recommend_queries import metric_rows
from trailmill.scale import beside, materialise
from trailmill.sources import tables


def unit_rows(rows, seed, width=16):
    found = np.random.default_rng(seed).normal(size=(rows, width))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def close_items():
    """Items of which many differ by less than single precision, and some are equal."""
    items = unit_rows(3000, 1)
    items[1::3] = items[::3] + 1e-8 * unit_rows(1000, 2)
    items[2::3] = items[::3]
    return items


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_first_look_keeps_ranks_and_lists(monkeypatch, kind):
    items, queries = close_items(), unit_rows(40, 3)
    monkeypatch.setattr(catalogue, "narrow", lambda lengths, longest: kind)
    known = catalogue.Catalogue(np.arange(3000), items.copy(), block=700)
    exact = np.round(np.einsum("qd,nd->qn", queries, items), 9)
    order = np.array([np.lexsort((np.arange(3000), -row)) for row in exact])
    wanted = np.random.default_rng(4).integers(0, 3000, 40)
    ranks = [int(np.flatnonzero(o == w)[0]) + 1 for o, w in zip(order, wanted)]
    assert catalogue.ranks_of(known, queries, wanted).tolist() == ranks
    rows, ids, scores = catalogue.best(known, queries, np.arange(40) % 7 + 1)
    for q in range(40):
        assert ids[rows == q].tolist() == order[q][: q % 7 + 1].tolist()
        assert scores[rows == q].tolist() == exact[q][order[q][: q % 7 + 1]].tolist()


def test_few_scores_are_worked_out_twice(monkeypatch):
    """A list of 5 of 20,000 items asks for a few exact scores per query, not for all above a threshold."""
    counts, inner = [], catalogue.exact_scores
    monkeypatch.setattr(catalogue, "exact_scores", lambda q, r, i, at: counts.append(len(r)) or inner(q, r, i, at))
    items, queries = unit_rows(20_000, 5), unit_rows(64, 6)
    known = catalogue.Catalogue(np.arange(20_000), items.copy())
    rows, ids, scores = catalogue.best_of(known, np.arange(20_000), queries, 5, 0.1)
    exact = np.round(queries @ items.T, 9)
    assert ids.reshape(64, 5).tolist() == known.ids[np.argsort(-exact[:, known.ids], axis=1, kind="stable")[:, :5]].tolist()
    assert sum(counts) < 64 * 200


def test_values_outside_single_precision():
    items = unit_rows(50, 7) * 1e25
    known = catalogue.Catalogue(np.arange(50), items.copy())
    queries = unit_rows(4, 8) * 1e20
    _, ids, _ = catalogue.best(known, queries, 3)
    assert ids.reshape(4, 3).tolist() == np.argsort(-(queries @ items.T), axis=1)[:, :3].tolist()


def test_missing_numbers_hide_no_other_item():
    items = unit_rows(30, 9)
    known = catalogue.Catalogue(np.arange(30), items.copy())
    known.vectors[10:] = np.nan
    _, ids, _ = catalogue.best_of(known, np.arange(30), unit_rows(2, 10), 20, -1.0)
    assert len(ids) == 20 and set(ids) == set(known.ids[:10])


def test_unit_works_the_length_out_once(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)], "id int, v array<double>")
    found = rows.select("id", unit(F.col("v")).alias("u"))
    assert {r.id: r.u for r in found.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT(") == 1 and plan.count("aggregate(") == 1


def test_sweep_infers_the_topics_of_a_session_once(spark, clicks_of, monkeypatch):
    clicks = clicks_of({s: "A B B C" if s % 2 else "D E E" for s in range(12)})
    bags, _ = features.session_bags(clicks)
    bags = materialise(bags)
    model = topics.fit_topics(bags, 2, 3, 42)
    expected = model.logPerplexity(bags)
    monkeypatch.setattr(type(model), "logPerplexity", lambda *_: pytest.fail("inferred twice"))
    (row,) = topics.lda_sweep(bags, [2], rounds=3).collect()
    assert row.k == 2 and row.log_perplexity == pytest.approx(expected, rel=1e-9)


def test_sweep_leaves_keeping_of_points_to_the_models(spark):
    kept = []

    class Watched(KMeans):
        def fit(self, dataset, params=None):
            kept.append(dataset.storageLevel.useMemory)
            return super().fit(dataset, params)

    rows = spark.createDataFrame([([0.0, 0.1 * i],) for i in range(9)] + [([9.0, 0.1 * i],) for i in range(9)], "v array<double>")
    points = rows.select(array_to_vector("v").alias("features"))
    found = clusters.k_sweep({"kmeans": Watched(maxIter=5)}, points, (2, 3)).collect()
    assert kept == [False, False]
    assert [r["k"] for r in found] == [2, 3] and found[0]["silhouette"] > found[1]["silhouette"]


def test_large_lookups_are_not_sorted(spark, monkeypatch):
    rows = spark.range(60).selectExpr("id % 7 as k", "id")
    side = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 1, 5, None)], "k long, name string")
    found = {}
    for limit, kind in ((5, "BroadcastHashJoin"), (4, "ShuffledHashJoin")):
        monkeypatch.setattr(tables, "BROADCAST_ROWS", limit)
        joined = rows.join(tables.looked_up(side), "k")
        assert kind in joined._jdf.queryExecution().executedPlan().toString()
        found[limit] = sorted(map(tuple, joined.collect()))
    assert found[4] == found[5] == sorted((r.k, r.id, n) for r in rows.collect() for k, n in ((0, "n0"), (1, "n1"), (1, "n1"), (5, "n5")) if r.k == k)


def test_summary_tells_sessions_apart_for_regions_only(spark):
    rows = [(1, "R", "a", "x"), (1, "R", "b", "x"), (1, "R", "a", "y"), (2, "S", "b", "x"), (3, "S", None, "y"), (None, "S", "a", "y")]
    row = explore.summary_row(spark.createDataFrame(rows, "session_id long, region string, category string, colour string"))
    assert tuple(row.first()) == (6, "S", 2, "a", 3, "x", 3)
    assert "(dimension" in (plan := row._jdf.queryExecution().optimizedPlan().toString()) and "= region) THEN session_id" in plan


def held_out(spark, models):
    """Sessions without lists, lists without sessions, null keys, repeated rows, an item without training clicks and a model without lists."""
    truth = [(1, 1, True), (2, 5, False), (3, 2, True), (3, 4, False), (3, 4, False), (4, 1, True), (6, 0, None), (None, 1, True)]
    train = [(9, 0, 3), (9, 1, 1), (10, 2, 4), (10, 5, 2)]
    lists = [(1, 2, 1), (1, 1, 2), (2, 5, 1), (2, 5, 3), (3, 4, 1), (3, 2, 11), (3, 9, 2), (5, 0, 1), (6, 0, 1), (None, 1, 1)]
    parts = {m: [(s, (i + n) % 10 if n else i, r) for s, i, r in lists[n:]] if m != "empty" else [] for n, m in enumerate(models)}
    t = SimpleNamespace(
        truth=spark.createDataFrame(truth, "session_id long, item_idx int, is_cold boolean"),
        train=spark.createDataFrame(train, "session_id long, item_idx int, click_count long"),
        index=spark.range(10),
    )
    return t, {m: spark.createDataFrame(rows, "session_id long, item_idx int, rank int") for m, rows in parts.items()}


def test_metrics_of_all_models_are_those_of_each(spark):
    t, models = held_out(spark, ["a", "b", "c", "empty"])
    want = {}
    for track, truth in (("warm", t.truth), ("cold", t.truth.filter("is_cold"))):
        for model, recs in models.items():
            own = recs if track == "warm" else recs.join(truth.select("session_id"), "session_id", "left_semi")
            for row in (evaluate.rank_metrics(own, truth).first(), evaluate.coverage_novelty(own, t.train, 10).first()):
                want |= {(track, model, name): value for name, value in row.asDict().items() if name not in ("sessions", "unique_items")}
    found = {(r.track, r.model, r.metric): r.value for r in metric_rows(t, models).collect()}
    assert found.keys() == want.keys() and len(found) == 40
    for key, value in want.items():
        assert found[key] == (None if value is None else pytest.approx(value, abs=1e-9)), key
    nobody = SimpleNamespace(truth=t.truth.limit(0), train=t.train, index=t.index)
    empty = {(r.track, r.metric): r.value for r in metric_rows(nobody, {"a": models["a"]}).collect()}
    assert empty["warm", "mrr"] is None and empty["cold", "coverage"] == 0 and empty["cold", "novelty"] is None and empty["warm", "coverage"] > 0


def test_metrics_take_no_more_jobs_for_more_models(spark):
    jobs = []
    for names in (["a"], ["a", "b", "c", "d", "empty"]):
        t, models = held_out(spark, names)
        spark.sparkContext.setJobGroup(group := f"metrics of {len(names)}", group)
        metric_rows(t, {m: materialise(recs) for m, recs in models.items()})
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) - len(names))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_work_beside_does_not_hold_up_the_block(spark):
    started, go_on = Event(), Event()

    def work():
        started.set()
        assert go_on.wait(60)
        return spark.range(5).count()

    with beside(spark, work) as done:
        assert started.wait(60) and not done.done() and spark.range(3).count() == 3
        go_on.set()
        assert done.result() == 5
    with pytest.raises(ZeroDivisionError), beside(spark, lambda: 1 // 0) as done:
        done.result()

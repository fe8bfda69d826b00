"""Hand-made frames with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from trailmill.functions import arrays, scalars
from trailmill.operators import evaluate, frequency, graph, quality, recommend, rules, sequences, splits
from trailmill.sources import io


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_header_names():
    assert scalars.header_name("page 1 (main category)") == "page_1_main_category"
    assert scalars.header_name("session ID") == "session_id"


def test_regions(spark):
    df = spark.createDataFrame([(29,), (2,), (7,), (1,), (12,), (13,)], "country int")
    got = [tuple(r) for r in df.select(scalars.region_label(F.col("country")), scalars.region_code(F.col("country"))).collect()]
    assert got == [
        ("Poland", 0), ("Other_EU", 1), ("Europe_non_EU", 2), ("Outside_Europe", 3),
        ("Unidentified_or_Domain", 4), ("Unidentified_or_Domain", 4),
    ]


def test_unknown_code_is_null_or_default(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "c int")
    names = {1: "one"}
    got = df.select(scalars.code_name(F.col("c"), names), scalars.code_name(F.col("c"), names, "unknown")).collect()
    assert [tuple(r) for r in got] == [("one", "one"), (None, "unknown"), (None, "unknown")]


def test_code_text(spark):
    df = spark.createDataFrame([(" 12.0 ",), ("7",), ("1.05",)], "c string")
    assert [r[0] for r in df.select(scalars.code_text(F.col("c"))).collect()] == ["12", "7", "1.05"]


def test_collapse_keeps_last_run(clicks_of):
    c = clicks_of({1: "A A B B"})
    assert rows(sequences.collapse_repeats(c), "click_order", "item_id") == [(2, "A"), (4, "B")]


def test_collapse_without_last_run(clicks_of):
    c = clicks_of({1: "A A B B", 2: "A B B", 3: "C"})
    got = sequences.collapse_repeats(c, keep_last_run=False)
    assert rows(got, "session_id", "click_order", "item_id") == [(1, 2, "A"), (2, 1, "A")]


def test_prefixes(clicks_of):
    got = sequences.prefix_sequences(clicks_of({1: "A B C"}))
    assert rows(got, "prefix", "next") == [(["A"], "B"), (["A", "B"], "C")]


def test_leave_last_out(clicks_of):
    held = splits.leave_last_out(clicks_of({1: "A B C", 2: "A"}))
    assert rows(splits.ground_truth(held), "session_id", "item_id", "n_context") == [(1, "C", 2)]
    assert rows(splits.context(held), "session_id", "item_id") == [(1, "A"), (1, "B")]


def with_gaps(clicks_of, sessions, gap):
    """Clicks whose item is null where it says so."""
    clicks = clicks_of(sessions)
    return clicks.withColumns({c: F.when(F.col("item_id") != gap, F.col(c)) for c in ("item_no", "item_id")})


def test_leave_last_out_with_null_items(clicks_of):
    held = splits.leave_last_out(with_gaps(clicks_of, {1: "A X B", 2: "A X"}, "X"))
    assert rows(held.filter("is_truth"), "session_id", "click_order", "item_id") == [(1, 3, "B"), (2, 2, None)]


def test_leave_last_out_over_missing_positions(clicks_of):
    held = splits.leave_last_out(clicks_of({1: "A B C D"}).filter("click_order != 3"))
    assert rows(held, "click_order", "is_truth") == [(1, False), (2, False), (4, True)]


@pytest.mark.parametrize("item", ["item_id", "item_no"])
def test_null_items_make_no_pairs(clicks_of, item):
    clicks = with_gaps(clicks_of, {1: "A X B", 2: "A C", 3: "X"}, "X").withColumn("g", F.lit(1))
    names = {"item_id": ("A", "B", "C"), "item_no": (0, 1, 2)}[item]
    got = rules.pair_rules(clicks, item, "g")
    assert rows(got, "item_a", "item_b", "pair_count", "sessions") == [(names[0], names[1], 1, 2), (names[0], names[2], 1, 2)]


def test_transitions_count_self_moves_in_the_total(clicks_of):
    got = sequences.transitions(clicks_of({1: "A A B"}))
    assert rows(got, "src", "dst", "moves", "weight") == [("A", "B", 1, 0.5)]


def test_unknown_tokens_are_null(clicks_of):
    known = sequences.tokens(clicks_of({1: "A"}), ["item_id"])
    got = sequences.tokenise(clicks_of({1: "A B"}), ["item_id"], known)
    assert [r[0] is None for r in got.orderBy("click_order").select("token").collect()] == [False, True]


def test_pair_rules(clicks_of):
    c = clicks_of({1: "A B", 2: "B A", 3: "A", 4: "B"}).withColumn("region", F.lit("X"))
    r = rules.pair_rules(c, "item_id", "region").first()
    assert (r.item_a, r.item_b, r.pair_count, r.support) == ("A", "B", 2, 0.5)
    assert r.confidence_ab == r.confidence_ba == pytest.approx(2 / 3)
    assert r.lift == pytest.approx(8 / 9)


def index_of(spark):
    return spark.createDataFrame([("A", 0), ("B", 1), ("C", 2)], "item_id string, item_idx int")


def test_cosine_similarity(spark, clicks_of):
    train = recommend.interactions(clicks_of({1: "A A B", 2: "A"}), index_of(spark))
    got = rows(recommend.item_similarity(train), "seed_idx", "target_idx", "similarity")
    assert got == [(0, 1, pytest.approx(2 / math.sqrt(5))), (1, 0, pytest.approx(2 / math.sqrt(5)))]


def test_exclude_seen_and_ties(spark):
    scores = spark.createDataFrame([(1, 0, 0.9), (1, 1, 0.9), (1, 2, 0.1)], "session_id long, item_idx int, score double")
    seen = spark.createDataFrame([(1, 0)], "session_id long, item_idx int")
    assert rows(recommend.exclude_seen(scores, seen), "rank", "item_idx") == [(1, 1), (2, 2)]
    nothing = seen.limit(0)
    assert rows(recommend.exclude_seen(scores, nothing, 2), "rank", "item_idx") == [(1, 0), (2, 1)]


def test_rank_metrics(spark):
    truth = spark.createDataFrame([(1, 1), (2, 5)], "session_id long, item_idx int")
    recs = spark.createDataFrame([(1, 2, 1), (1, 1, 2)], "session_id long, item_idx int, rank int")
    m = evaluate.rank_metrics(recs, truth).first()
    # the second session has no list and counts as zero
    assert (m.mrr, m.precision, m.recall, m.sessions) == (0.25, 0.05, 0.5, 2)


def test_prefix_metrics_skip_missing_lists(spark):
    recs = spark.createDataFrame(
        [(1, 3, 7, 9, 1), (1, 3, 7, 7, 2)], "session_id long, click_order int, next int, item_idx int, rank int"
    )
    m = evaluate.prefix_metrics(recs).first()
    assert m.recall == 1 and m.ndcg == pytest.approx(1 / math.log2(3)) and m.prefixes == 1


def test_coverage_and_novelty(spark):
    train = spark.createDataFrame([(1, 0, 3), (2, 1, 1)], "session_id long, item_idx int, click_count long")
    recs = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (2, 9, 2)], "session_id long, item_idx int, rank int")
    m = evaluate.coverage_novelty(recs, train, 4).first()
    assert m.unique_items == 3 and m.coverage == 0.75
    assert m.novelty == pytest.approx((-math.log2(0.75) - math.log2(0.25)) / 2)


def test_comparison_with_zero_baseline(spark):
    metrics = spark.createDataFrame(
        [("warm", "popularity", "mrr", 0.0), ("warm", "knn", "mrr", 0.2)],
        "track string, model string, metric string, value double",
    )
    got = {r.model: r for r in evaluate.compare_models(metrics).collect()}
    assert got["knn"].change is None and got["knn"].delta == 0.2 and got["knn"].is_best


def edges_of(spark, text):
    pairs = [tuple(e.split(">")) for e in text.split()]
    return spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src string, dst string, weight double")


def vertices_of(edges):
    return graph.both_ends(edges).select("id").distinct()


def test_triangle_rotations(spark):
    got = graph.triangles(edges_of(spark, "a>b b>c c>a c>d"))
    assert rows(got, "a", "b", "c") == [("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")]


def test_components(spark):
    edges = edges_of(spark, "b>a c>b d>c y>x")
    vertices = vertices_of(edges).union(spark.createDataFrame([("q",)], "id string"))
    got = dict(rows(graph.components(vertices, edges), "id", "component"))
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x", "q": "q"}


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(60)], "src int, dst int, weight double")
    got = graph.components(vertices_of(edges), edges)
    assert rows(got.select("component").distinct(), "component") == [(0,)]


def test_pagerank_with_a_sink_keeps_the_total(spark):
    edges = edges_of(spark, "a>b b>c a>c")
    ranks = dict(rows(graph.pagerank(vertices_of(edges), edges, rounds=20), "id", "rank"))
    assert sum(ranks.values()) == pytest.approx(3)
    assert ranks["c"] > ranks["b"] > ranks["a"]


def test_label_propagation_on_two_cliques(spark):
    edges = edges_of(spark, "a>b b>c c>a x>y y>z z>x")
    got = dict(rows(graph.label_propagation(vertices_of(edges), edges, 5), "id", "label"))
    assert {got[v] for v in "abc"} == {"a"} and {got[v] for v in "xyz"} == {"x"}


def test_power_iteration_separates_cliques(spark):
    def clique(ids):
        return [(a, b, 1.0) for a in ids for b in ids if a < b]

    edges = spark.createDataFrame(clique(range(6)) + clique(range(10, 16)) + [(5, 10, 0.01)], "src int, dst int, weight double")
    got = dict(rows(graph.power_iteration(edges, k=2, rounds=30), "id", "cluster"))
    assert len({got[i] for i in range(6)}) == 1 and got[0] != got[12]


def test_path_counts_match_enumeration(spark):
    text = "a>b b>c c>a b>a c>d d>b"
    pairs = [tuple(e.split(">")) for e in text.split()]
    expected = {}
    for _, b in pairs:
        for b2, c in pairs:
            for c2, d in pairs:
                if b == b2 and c == c2:
                    expected[(c, d)] = expected.get((c, d), 0) + 1
    got = {(s, d): n for s, d, n in rows(graph.path_counts(edges_of(spark, text)), "src", "dst", "paths")}
    assert got == expected


def test_zipf_ignores_exact_counts(clicks_of):
    c = clicks_of({1: " ".join("A" * 8 + "B" * 4 + "C" * 2 + "D")})
    ranked = frequency.ranked_frequencies(c)
    assert rows(ranked, "rank", "item_id", "clicks_upto") == [(1, "A", 8), (2, "B", 12), (3, "C", 14), (4, "D", 15)]
    assert frequency.zipf_fit(ranked, ignore_top=1, ignore_bottom=1).first().items == 2


def test_duplicate_and_contract(spark, clicks_of):
    c = clicks_of({1: "A B"}).union(clicks_of({1: "A"}))
    assert rows(quality.duplicate_keys(c, ["session_id", "click_order"]), "click_order", "copies") == [(1, 2)]
    checks = {r.check: r.ok for r in quality.contract_checks(c, ["item_id"], {"item_id": 2}, rows=3).collect()}
    assert checks == {"rows": True, "item_id never null": True, "item_id distinct": True}


def test_split_parts_are_disjoint_and_stable(spark):
    c = spark.range(1000).select(F.col("id").alias("session_id"))
    split = splits.stratified_split(c, 0.8, seed=42)
    train = {r[0] for r in split.filter("in_train").collect()}
    again = {r[0] for r in splits.stratified_split(c.repartition(7), 0.8, seed=42).filter("in_train").collect()}
    assert train == again and 740 < len(train) < 860


def test_split_with_fraction_per_length(clicks_of):
    c = clicks_of({i: "A" if i % 2 else "A B" for i in range(40)})
    got = splits.stratified_split(c, 0.5, per_length={1: 1.0, 2: 0.0})
    assert {(r.session_id % 2, r.in_train) for r in got.collect()} == {(1, True), (0, False)}


def test_zero_vector_cosine(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert df.select(arrays.cosine(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_rows_frame_and_nested_metrics(spark):
    frame = io.rows_frame(spark, [("warm", "knn", "mrr", 0.5), ("warm", "als", "mrr", 0.25)], "track string, model string, metric string, value double")
    assert io.schema_rows(frame)[0] == ("track", "string") and io.preview(frame, 1).count() == 1
    assert io.nested_metrics(frame).first().models == '{"als":{"mrr":0.25},"knn":{"mrr":0.5}}'.replace('{"mrr":0.25}', '"{\\"mrr\\":0.25}"').replace('{"mrr":0.5}', '"{\\"mrr\\":0.5}"')

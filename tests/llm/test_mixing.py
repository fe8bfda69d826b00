from collections import defaultdict

from edge import frame, odd_texts, prose
from pyspark.sql import functions as F

from trailmill.llm import mixing


def level(sizes, weights, most):
    """Targets by sharing the excess again and again."""
    total, capped = sum(sizes), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, c in zip(sizes, capped) if c)
        share = sum(w for w, c in zip(weights, capped) if not c)
        targets = [most * s if c else left * w / share for s, w, c in zip(sizes, weights, capped)]
        over = [i for i, t in enumerate(targets) if not capped[i] and t > most * sizes[i]]
        if not over:
            return targets
        for i in over:
            capped[i] = True


def test_targets_and_sums(spark):
    names = ["b", "a", None, "c", "ä", "Z"]
    counts = [60, 5, 8, 90, 40, 200]
    texts, sources = [], []
    for j, (name, n) in enumerate(zip(names, counts)):
        texts += [prose(10 + (i * 37 + j) % 90, i * 10 + j) for i in range(n)]
        sources += [name] * n
    sized, plan = mixing.mix_plan(frame(spark, texts, sources))
    rows = mixing.with_copies(sized, plan).collect()
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["copies"] <= 3
    order = sorted((n for n in by if n is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    want = level(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))], 3)
    for s, size, target in zip(order, sizes, want):
        assert by[s][0]["source_size"] == size and abs(by[s][0]["target"] - target) < 1e-6 * target
        taken = sum(r["copies"] * r["size"] for r in by[s])
        assert abs(taken - target) <= 0.02 * target + 5, (s, taken, target)
        spread = {r["copies"] for r in by[s]}
        assert max(spread) - min(spread) <= 1
    again = mixing.with_copies(*mixing.mix_plan(frame(spark, texts, sources))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_larger_documents_are_drawn_more_often(spark):
    sizes = [4] * 400 + [64] * 400
    docs = frame(spark, [" ".join(["w"] * n) + f" {i}" for i, n in enumerate(sizes)] + ["x"] * 10, ["a"] * 800 + ["b"] * 10)
    sized, plan = mixing.mix_plan(docs, weights=(1, 3))
    drawn = mixing.with_copies(sized, plan).where("source = 'a' and copies > 0")
    n = {r["size"]: r["n"] for r in drawn.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[65] >= n[5]


def test_odd_documents(spark):
    texts = odd_texts()
    ids = [None if i in (2, 3) else 7 if i > 8 else i for i in range(len(texts))]
    docs = frame(spark, texts, [None if i % 4 == 0 else f"s{i % 3}" for i in range(len(texts))], ids)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and all(r["text"] and r["text"].strip() for r in mixed.collect())
    for empty in (frame(spark, []), frame(spark, [None, "", " "])):
        assert mixing.mixed(empty).count() == 0
    sized, plan = mixing.mix_plan(frame(spark, [None, ""]))
    assert [r["copies"] for r in mixing.with_copies(sized, plan).collect()] == [0, 0]


def test_the_mix_repeats_rows_as_planned(spark):
    docs = frame(spark, [prose(20 + i, i) for i in range(60)], ["a"] * 10 + ["b"] * 50)
    sized, plan = mixing.mix_plan(docs)
    want = {r["doc_id"]: r["copies"] for r in mixing.with_copies(sized, plan).collect() if r["copies"]}
    got = {r["doc_id"]: r["n"] for r in mixing.mixed(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_equal_rows_are_taken_one_by_one(spark):
    text = " ".join(["word"] * 10)
    docs = frame(spark, [text] * 400 + [prose(10, i) for i in range(400)], ["a"] * 400 + ["b"] * 400, ids=[7] * 400 + list(range(400)))
    sized, plan = mixing.mix_plan(docs, weights=(1, 3))
    rows = mixing.with_copies(sized, plan)
    sums = {r["source"]: (r["target"], r["taken"]) for r in rows.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    assert rows.count() == 800
    for target, taken in sums.values():
        assert abs(target - taken) <= 10
    out = mixing.mixed(docs, weights=(1, 3)).groupBy("source").count().collect()
    assert {r["source"]: r["count"] * 10 for r in out} == {s: t for s, (_, t) in sums.items()}
    assert sorted(map(str, rows.collect())) == sorted(map(str, mixing.with_copies(*mixing.mix_plan(docs, weights=(1, 3))).collect()))


def test_sources_are_not_mixed_up_by_null(spark):
    docs = frame(spark, ["one two three"] * 6, [None, None, None, "x", "x", "x"], ids=[1] * 6)
    sized, plan = mixing.mix_plan(docs)
    assert mixing.with_copies(sized, plan).count() == 6 and sized.select("source", "draw").distinct().count() == 6

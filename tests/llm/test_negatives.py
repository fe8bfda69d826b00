import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmill.llm import negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block string, qid string, slot int, score string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "x", "y", "z", 1, "s", 2) for i, v, n in rows], SCHEMA)


def brute(rows, asked, k=5, least=80):
    usable = []
    for i, v, n in rows:
        if None not in (i, v, n) and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, n, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for at, (anchor, label, vector) in enumerate(usable):
        if anchor % asked:
            continue
        scores = sorted((-sum(a * b for a, b in zip(vector, w)), i, n) for j, (i, n, w) in enumerate(usable) if j != at)
        for p, positive, _ in [s for s in scores if s[2] == label][:k]:
            found = [s for s in scores if s[2] != label and least * -p <= 100 * -s[0] <= 100 * -p]
            out += [(anchor, positive, r, i, -p, -s) for r, (s, i, _) in enumerate(found[:k], 1)]
    return sorted(out)


def odd_rows(n=400, width=11, seed=1):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([0.0, 0.25, -0.5, rnd.uniform(-1, 1)]) for _ in range(width)], rnd.randrange(4)) for i in range(n)]
    near = [rnd.uniform(0, 1) for _ in range(width)]
    rows += [(n + i, [x + rnd.uniform(-0.05, 0.05) for x in near], rnd.randrange(4)) for i in range(n // 4)]
    rows += [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 3, 1), (903, [float("inf")], 1), (None, [1.0] * 4, 1), (904, [1.0], None)]
    rows += [(905, [], 1), (910, [], 2), (906, [1.0, 2.0], 3), (0, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2]), (0, [3.0] * 20, 2), (n, rows[n][1], 3), (10, rows[n][1], 0)]
    return rows


@pytest.mark.parametrize(("chunk", "block"), [(7, 16_384), (8_192, 16_384), (64, 5)])
def test_equal_to_brute_force(spark, monkeypatch, chunk, block):
    rows = odd_rows()
    numbered = vectors.with_blocks
    monkeypatch.setattr(negatives, "with_blocks", lambda q, name: numbered(q, name, block))
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, chunk=chunk).collect()
    want = brute(rows, 10)
    assert len(want) > 100 and sorted(map(tuple, found)) == want


def test_lookups_give_inner_products():
    rnd = np.random.default_rng(2)
    for width, reach in ((1, 3), (8, 300), (64, 256), (13, 10**6), (5, 10**8)):
        rows, anchors = rnd.integers(-reach, reach, (50, width)), rnd.integers(-reach, reach, (9, width))
        planes = negatives.bit_planes(rows)
        table = negatives.subset_sums(anchors.astype(negatives.table_type(anchors, len(planes))))
        assert table.shape == (-(-width // 8), 256, 9)
        assert (negatives.scores_of(table, planes) == rows @ anchors.T).all()
        assert (table[0, 0b10000000] == anchors[:, 0]).all() and (table[:, 0] == 0).all()


def test_windows_round_to_whole_scores():
    scores = np.array([-101, -100, -1, 0, 1, 99, 100, 101, 2**61])
    assert negatives.share(80, scores, True).tolist() == [-(-80 * s // 100) for s in scores.tolist()]
    assert negatives.share(80, scores, False).tolist() == [80 * s // 100 for s in scores.tolist()]


def test_nothing_to_find(spark):
    none = frame(spark, [])
    assert negatives.hard_negatives(none, F.lit(True)).count() == 0
    alone = frame(spark, [(0, [1.0], 1), (1, [1.0], 2)])
    assert negatives.hard_negatives(alone, F.col("vec_id") == 0).count() == 0
    tied = frame(spark, [(0, [1.0], 1), (1, [1.0], 1), (3, [1.0], 2), (2, [1.0], 2), (4, [0.79], 2), (5, [1.1], 2)])
    rows = negatives.hard_negatives(tied, F.col("vec_id") == 0).collect()
    assert [(r["positive_id"], r["rank"], r["negative_id"]) for r in sorted(rows)] == [(1, 1, 2), (1, 2, 3)]

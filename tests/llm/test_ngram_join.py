import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge import frame, odd_texts, prose
from pyspark.sql import functions as F

from trailmill.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(texts, ids):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i in range(len(texts)):
        own = [ids[j] for j in range(len(texts)) if find(j) == find(i) and ids[j] is not None]
        out.append((ids[i], len(sets[i]), min(own, default=None) if sets[i] else ids[i]))
    return sorted(out, key=str)


def edited(text, edits, rnd):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10_000)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [4, 1_024])
def test_equal_to_brute_force(spark, block):
    rnd, texts = random.Random(5), odd_texts()
    for n in (3, 5, 9, 10, 11, 12, 19, 20, 21, 28, 40, 60, 120, 170, 400):
        base = prose(n, n)
        texts += [edited(base, k, rnd) for k in (0, 0, 1, 1, 1, 2, 2, 3, 5, 8)] + [base.upper(), base + " tail", base.rsplit(" ", 1)[0]]
    passage = prose(80, 77)
    texts += [f"{passage} {prose(60, 900 + i)}" for i in range(20)]
    rnd.shuffle(texts)
    ids = list(range(len(texts)))
    ids[3], ids[10], ids[11] = None, None, 2
    rows = ngram_join.similar_sets(frame(spark, texts, ids=ids), block=block).select("doc_id", "n_shingles", "component_id").collect()
    got, want = sorted(map(tuple, rows), key=str), brute(texts, ids)
    assert got == want


def test_small_sets_of_nine_and_ten(spark):
    base = [f"w{i}" for i in range(12)]
    texts = [" ".join(base[:11]), " ".join(base), "w0", "w0 w1", "W0 w1", "w0  w1"]
    rows = ngram_join.similar_sets(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in rows] == [0, 0, 2, 3, 3, 3] and [r["n_shingles"] for r in rows] == [9, 10, 1, 1, 1, 1]


def test_one_stays_per_component(spark):
    rnd, base = random.Random(1), prose(200, 3)
    docs = frame(spark, [base, base, edited(base, 1, rnd), prose(200, 4), None, ""], ids=[5, 2, 9, 1, 7, 8])
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 7, 8]
    assert ngram_join.one_per_component(frame(spark, [])).count() == 0
    assert ngram_join.similar_sets(frame(spark, [])).count() == 0


def test_linked_sets_share_a_key():
    rnd = np.random.default_rng(3)
    new = lambda n: rnd.integers(0, 2**64, n, dtype=np.uint64)
    for share in (0.0, 0.5, 0.95, 1.0):  # of token classes that are frequent
        counts = np.where(rnd.random(1 << 16) < share, 10**6, 3)
        index = ngram_join.Index(90, counts)
        index.limit = 100.0
        for size in [9, 10, 17, 18, 30, 52, 53, 84, 85, 90, 300, 400, 2000]:
            for _ in range(25):
                common = new(size)
                both = size // 9
                left = int(rnd.integers(0, both + 1))
                a = np.unique(np.concatenate([common[both:], new(left)]))
                b = np.unique(np.concatenate([common[both:], new(both - left)]))
                inter = len(np.intersect1d(a, b))
                if 100 * inter >= 90 * (len(a) + len(b) - inter):
                    assert set(index.keys(a).tolist()) & set(index.keys(b).tolist())


def test_rare_tokens_alone_and_frequent_ones_combined():
    tokens = np.arange(1, 101, dtype=np.uint64) << np.uint64(20)
    rare = ngram_join.Index(90, np.ones(1 << 10, dtype=np.int64))
    assert len(rare.keys(tokens)) == 2 * 11  # the prefix of 100 tokens, in two bands
    counts = np.full(1 << 10, 10**6)
    common = ngram_join.Index(90, counts)
    common.limit = 10.0
    assert len(common.keys(tokens)) > 2 * 11 and not set(common.keys(tokens)) & set(rare.keys(tokens))


def test_a_common_phrase_makes_no_group(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(5_000)]
    ends = ["all rights reserved by the owner", "click here to read the rest", "share this page with your friends"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(15, 60))) + " " + rnd.choice(ends) for _ in range(3_000)]
    rows = ngram_join.indexed(frame(spark, texts), 3, 90).select("keys").collect()
    seen = [k for r in rows for k in r["keys"]]
    counts = np.unique(np.array(seen), return_counts=True)[1]
    assert counts.max() < 40


def test_rows_are_told_apart_by_id_and_text(spark):
    a, b = prose(100, 1), prose(100, 2)
    docs = frame(spark, [a, a, b, a, a, a, b], ids=[2, 5, 5, 2, 2, None, None])
    kept = ngram_join.one_per_component(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(2, a), (5, b)]
    nameless = ngram_join.one_per_component(frame(spark, [a, a + " more"], ids=[None, None])).collect()
    assert len(nameless) == 1


def test_parity_bits_never_exceed_the_differing_tokens():
    rnd = np.random.default_rng(7)
    for size in (1, 9, 40, 300, 2_000):
        for edits in (0, 1, 5, 40, 600):
            base = np.unique(rnd.integers(0, 2**64, size, dtype=np.uint64))
            other = np.unique(np.concatenate([base[edits:], rnd.integers(0, 2**64, edits, dtype=np.uint64)]))
            apart = ngram_join.parity(base).view(np.uint64) ^ ngram_join.parity(other).view(np.uint64)
            assert np.bitwise_count(apart).sum() <= len(np.setxor1d(base, other))


def test_differences_come_back():
    for values in ([], [0], [5, 5, 9], [3, 2**40, 2**63]):
        given = np.array(values, dtype=np.uint64)
        assert ngram_join.summed(ngram_join.differences(given)).tolist() == values


def test_sets_that_share_a_key_by_chance_are_not_chained(spark):
    """Every set shares a key with the next one, and only one pair is alike; all were one coarse group before."""
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 2**64, 100, dtype=np.uint64)) for _ in range(200)]
    sets.append(np.append(sets[7][2:], np.uint64(1)))
    keys = [[i, i + 1] for i in range(200)] + [[7]]
    rows = [
        (i, f"r{i}", ngram_join.set_hash(t), len(t), ngram_join.mix(np.array(k, dtype=np.uint64)).view(np.int64).tolist(), ngram_join.parity(t).tolist())
        for i, (t, k) in enumerate(zip(sets, keys, strict=True))
    ]
    df = spark.createDataFrame(rows, "doc_id long, row string, node long, n_shingles long, keys array<long>, parity array<long>")
    nodes = df.groupBy("node").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    assert ngram_join.components(ngram_join.common_keys(df)).count() == 201
    found = ngram_join.components(ngram_join.near_pairs(df, nodes, 90)).collect()
    assert {r["node"] for r in found} == {rows[7][2], rows[200][2]}


def test_only_shared_keys_are_exchanged(spark):
    texts = [prose(60, i) for i in range(400)] + [prose(60, 5) + " tail", prose(60, 6)]
    rows = ngram_join.stored(ngram_join.indexed(frame(spark, texts), 3, 90), "sets")
    nodes = rows.groupBy("node").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    copies = ngram_join.copied_sets(nodes)
    some = {(r["key"], r["node"]) for r in ngram_join.shared_entries(rows, copies, ngram_join.shared_bits(rows, copies)).collect()}
    every = {(k, r["node"]) for r in rows.collect() for k in r["keys"]}
    held = {}
    for key, node in every:
        held.setdefault(key, set()).add(node)
    shared = {(k, n) for k, found in held.items() if len(found) > 1 for n in found}
    assert shared and shared <= some <= every and len(some) < len(every) // 10


@pytest.mark.parametrize("together", [1, 3, 4_096])
def test_keys_of_any_size_are_joined_in_any_batches(together, monkeypatch):
    """Links of sorted rows against those of all pairs; beyond ``together`` a key is one group."""
    monkeypatch.setattr(ngram_join, "TOGETHER", together)
    rnd = np.random.default_rng(together)
    rows = []
    for key in range(40):
        base = [rnd.integers(0, 2**64, 60, dtype=np.uint64) for _ in range(3)]
        for _ in range(int(rnd.integers(1, 9))):
            tokens = base[rnd.integers(0, 3)].copy()
            tokens[: rnd.integers(0, 8)] += np.uint64(1)
            rows.append((key - 20, int(rnd.integers(0, 10**6)), 60, *ngram_join.parity(tokens).tolist()))
    rows += rnd.permutation(np.array(rows, dtype=np.int64))[:30].tolist()
    rows = sorted(map(tuple, rows))
    names = ["key", "node", "n", "p0", "p1", "p2", "p3"]
    table = pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, zip(*rows, strict=True), strict=True)})

    def groups(edges):
        root = {n: n for e in edges for n in e}
        for a, b in edges:
            old, new = root[a], root[b]
            root = {n: new if r == old else r for n, r in root.items()}
        return {frozenset(n for n in root if root[n] == r) for r in root.values()}

    want = []
    for key in {r[0] for r in rows}:
        own = sorted({r[1:] for r in rows if r[0] == key})
        for i, a in enumerate(own):
            for b in own[:i]:
                apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a[2:], b[2:], strict=True))
                if len(own) > together or apart * 190 <= 120 * 10:
                    want.append((a[0], b[0]))
    for size in (1, 7, 1_000):
        batches = list(ngram_join.likely_links(90)(iter(table.to_batches(size))))
        got = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        assert groups(got) == groups(want)


def test_rows_without_copies_do_not_move(spark, monkeypatch):
    """Only rows marked by a hash meet the sides that are too large to send; all rows did before."""
    monkeypatch.setattr("trailmill.scale.BROADCAST_ROWS", 0)
    rnd, base = random.Random(1), prose(200, 3)
    docs = frame(spark, [base, base, edited(base, 1, rnd), prose(200, 4), None, "", prose(90, 1)], ids=[5, 5, 9, 1, 7, 8, 3])
    kept = ngram_join.one_per_component(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 7, 8]
    assert "BroadcastHashJoin [mark" in kept._jdf.queryExecution().executedPlan().toString()

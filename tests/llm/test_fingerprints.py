import hashlib
import random
import re

import pytest
from edge import frame, odd_texts, prose

from trailmill.llm import fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(texts, ids):
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, (texts[i] or "").encode()))
    out = []
    for at, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        out.append((ids[i], len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(shingle_set(text), shingle_set(edited)), jaccard(shingle_set(text), shingle_set(after)), text))
    return out


@pytest.mark.parametrize("size", [1 << 30, 3_000, 60])
def test_follows_brute_force(spark, size):
    texts = odd_texts() + [prose(40 + i, i) for i in range(60)] + ["The End of it all, as they say"] * 2
    ids = [7 * i - 100 for i in range(len(texts))]
    ids[4], ids[9], ids[20], ids[30] = None, None, ids[21], ids[31]
    rows = fingerprints.edited_fingerprints(frame(spark, texts, ids=ids), size=size).collect()
    want = brute(texts, ids)
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows if r["doc_id"] is not None) == sorted(w[:3] for w in want if w[0] is not None)
    assert sorted(r["edited_sha256"] for r in rows) == sorted(w[2] for w in want)
    near = {(w[0], w[2]): w[3:5] for w in want}
    prints = {}
    for r in rows:
        edited, following = near[r["doc_id"], r["edited_sha256"]]
        assert abs(r["near_edited"] - edited) < 0.2 and abs(r["near_next"] - following) < 0.2
        prints.setdefault(r["fingerprint"], []).append(r["doc_id"])
    same = {}
    for w in want:
        same.setdefault(frozenset(shingle_set(w[5])), []).append(w[0])
    assert sorted(map(len, prints.values())) == sorted(map(len, same.values()))


def test_alone_and_empty(spark):
    assert fingerprints.edited_fingerprints(frame(spark, [])).count() == 0
    row = fingerprints.edited_fingerprints(frame(spark, ["abcdefgh"])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1.0
    rows = fingerprints.edited_fingerprints(frame(spark, [None, "", "a b"], ids=[None, None, 3]), size=1).collect()
    assert sorted(r["near_next"] for r in rows) == [0.0, 0.0, 1.0]


def test_likeness_estimates_jaccard():
    import numpy as np

    rnd, errors = np.random.default_rng(6), []
    for share in (0.1, 0.3, 0.5, 0.8, 0.95):
        for _ in range(20):
            common, n = rnd.integers(0, 2**64, int(1000 * share), dtype=np.uint64), int(1000 * (1 - share) / 2)
            a, b = (fingerprints.signature(np.concatenate([common, rnd.integers(0, 2**64, n, dtype=np.uint64)])) for _ in "ab")
            errors.append(fingerprints.likeness(a, b) - share)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_near_duplicates_are_verified(spark):
    rnd, texts = random.Random(3), []
    for n in (6, 30, 80, 300):
        base = prose(n, n)
        for edits in (0, 0, 1, 1, 2, 4, 9):
            words = base.split(" ")
            for _ in range(edits):
                words[rnd.randrange(len(words))] = f"new{rnd.randrange(10_000)}"
            texts.append(" ".join(words))
    texts += odd_texts() + [prose(50, 900 + i) for i in range(30)]
    rows = fingerprints.near_duplicates(frame(spark, texts), block=4).orderBy("doc_id").collect()
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert [(r["n_shingles"], r["component_id"]) for r in rows] == [(len(s), find(i)) for i, s in enumerate(sets)]
    assert fingerprints.near_duplicates(frame(spark, [])).count() == 0

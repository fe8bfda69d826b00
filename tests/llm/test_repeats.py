import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from edge import frame, odd_texts, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmill.llm import repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i : i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[hash(d[i : i + length])] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def cut(spark, texts, **how):
    rows = repeats.without_repeats(frame(spark, texts), **how).collect()
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("group", [2_000, 3])
def test_equal_to_brute_force(spark, group):
    rnd = random.Random(6)
    shared = [prose(12, 50 + i)[:90] for i in range(6)]
    texts = [None, "", "short", "é" * 70]
    for i in range(60):
        parts = [prose(rnd.randint(1, 30), 100 + i * 7 + j) for j in range(3)]
        parts.insert(rnd.randint(0, 3), rnd.choice(shared)[rnd.randint(0, 20) : rnd.randint(50, 90)])
        parts.insert(rnd.randint(0, 3), rnd.choice(shared))
        texts.append(" ".join(parts))
    texts += [texts[10], texts[10], texts[11] + " x", texts[12][5:], "ab" * 100, shared[0] * 3, "z" * 200]
    assert cut(spark, texts, length=40, gram=10, group=group) == brute(texts, 40)


def test_default_lengths(spark):
    passage = prose(120, 1)
    texts = [prose(200, 2) + passage + prose(100, 3), prose(90, 4) + passage, passage[:399], passage[:400], prose(200, 5), prose(200, 5), passage + "|" + passage]
    texts += odd_texts()
    assert cut(spark, texts) == brute(texts, 400)


def test_many_contexts_are_halved(spark):
    passage = prose(100, 1)[:430]
    texts = [prose(60, 10 + i) + passage + prose(60, 500 + i) for i in range(25)]
    assert cut(spark, texts, group=4) == brute(texts, 400)


def maximal(texts, length):
    """Repeated strings of ``length`` bytes or more that differ, or end, on both sides."""
    places = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            for j in range(i + length, len(data) + 1):
                places.setdefault(data[i:j], set()).add((t, i))
    out = []
    for string, at in places.items():
        before = {texts[t][i - 1 : i] if i else None for t, i in at}
        after = {texts[t][i + len(string) : i + len(string) + 1] or None for t, i in at}
        if len(at) > 1 and (len(before) > 1 or None in before) and (len(after) > 1 or None in after):
            out.append(string)
    return out


def test_groups_hold_all_occurrences(spark):
    rnd = random.Random(4)
    passage, other = b"the grey heron waits by the water", b"seven small boats left the harbour"
    texts = []
    for i in range(14):
        ends = [bytes(rnd.choices(range(97, 123), k=12)) for _ in range(3)]
        one = passage[: rnd.choice([26, 30, len(passage)])]
        texts.append(ends[0] + one + ends[1] + other[rnd.choice([0, 3, 6]) :] + ends[2])
    rows = repeats.repeat_groups(frame(spark, [t.decode() for t in texts]), length=24, gram=4).collect()
    number = {hashlib.md5(t).digest(): i for i, t in enumerate(texts)}
    found, strings = {}, {}
    for r in rows:
        t = number[bytes(r["tid"])]
        found.setdefault(r["repeat"], set()).add((t, r["begin"]))
        strings.setdefault(r["repeat"], set()).add(texts[t][r["begin"] : r["begin"] + r["n_bytes"]])
    assert all(len(s) == 1 for s in strings.values())
    groups = {next(iter(strings[k])): at for k, at in found.items()}
    everywhere = {s: {(t, i) for t, d in enumerate(texts) for i in range(len(d)) if d.startswith(s, i)} for s in groups}
    assert groups == everywhere
    # a repeat that reaches beyond 20 bytes before or 24 after an anchor comes in pieces
    wanted = maximal(texts, 24)
    assert all(any(s in w for w in wanted) for s in groups) and all(any(s in w for s in groups) for w in wanted)


def brute_reaches(rows, length):
    """Longest extensions over all pairs of rows whose common left and right sides reach ``length``."""
    out = []
    for i, (left, right) in enumerate(rows):
        best = (-1, -1)
        for j, (other_left, other_right) in enumerate(rows):
            before = len(os.path.commonprefix([left, other_left]))
            after = len(os.path.commonprefix([right, other_right]))
            if i != j and before + after >= length:
                best = (max(best[0], before), max(best[1], after))
        out.append(best)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=6), st.binary(max_size=8)), min_size=1, max_size=25), st.booleans())
def test_tree_equals_all_pairs(given_rows, few):
    """Anchors of two bytes, reach 6, length 8; bytes of a small alphabet with zeros, sides that end early."""
    length, gram, reach = 8, 2, 6
    kinds = 2 if few else 3
    rows = [(g, bytes(x % kinds for x in a), bytes([9, 9]) + bytes(x % kinds for x in b[:6])) for g, a, b in given_rows]
    group = np.array([g for g, _, _ in rows])
    left, right = np.array([len(a) for _, a, _ in rows]), np.array([len(b) for _, _, b in rows])
    contexts = [a[::-1].rjust(reach, b"\0") + b.ljust(length, b"\0") for _, a, b in rows]
    tree = repeats.Tree(group, left, right, contexts, length, gram)
    before, after = tree.reaches()
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        assert list(zip(before[at].tolist(), after[at].tolist())) == brute_reaches([rows[i][1:] for i in at], length)
    for members, l, r in tree.groups():
        same = {(rows[i][0], rows[i][1][:l], rows[i][2][:r]) for i in members}
        key = next(iter(same))
        assert len(same) == 1 and len(members) > 1 and l + r >= length
        assert set(members.tolist()) == {i for i, (g, a, b) in enumerate(rows) if (g, a[:l], b[:r]) == key and len(a) >= l and len(b) >= r}
        for side, size in ((1, l), (2, r)):
            ends = {rows[i][side][size : size + 1] for i in members}
            assert len(ends) > 1 or ends == {b""}


def test_null_ids_and_empty_table(spark):
    text = prose(150, 7)
    rows = repeats.without_repeats(frame(spark, [text, text, "x"], ids=[None, None, None])).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, len(text.encode()), len(text.encode())]
    assert repeats.without_repeats(frame(spark, [])).count() == 0


def test_equal_strings_share_an_anchor():
    a, b = (prose(300, i).encode() for i in (1, 2))
    common = prose(100, 3).encode()[:400]
    one = repeats.anchors(a + common + b, 400, 100)
    two = repeats.anchors(b + common + a, 400, 100)
    inside = [{h for p, h in zip(*x) if begin <= p <= begin + 300} for x, begin in ((one, len(a)), (two, len(b)))]
    assert inside[0] & inside[1]

import random

import numpy as np
import pytest
from edge import frame, odd_texts
from pyspark.sql import functions as F

from trailmill.llm import languages

LETTERS = {"aa": "abcdeé", "bb": "opqrstñ", "cc": "ßxyzwä"}


def text(lang, rnd, n=40):
    return " ".join("".join(rnd.choice(LETTERS[lang]) for _ in range(rnd.randint(2, 7))) for _ in range(n))


def test_held_out_accuracy_and_rejection(spark):
    rnd = random.Random(1)
    langs = [rnd.choice(sorted(LETTERS)) for _ in range(200)]
    texts = [text(x, rnd) for x in langs] + odd_texts()[:4] + ["日本語 テキスト " * 20]
    docs = frame(spark, texts, langs=langs + [None] * 5)
    model = languages.fit(docs.where(~languages.held_out()).limit(190))
    rows = {r["doc_id"]: r for r in languages.predicted(docs, model).withColumn("held_out", languages.held_out()).collect()}
    out = [i for i in range(200) if rows[i]["held_out"]]
    assert len(out) > 20 and all(rows[i]["lang_pred"] == langs[i] for i in out)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3 and rows[203]["lang_pred"] in LETTERS
    assert rows[204]["rejected"] and np.mean([rows[i]["rejected"] for i in range(200)]) < 0.1


def test_nothing_but_the_text_decides(spark):
    rnd = random.Random(2)
    texts = [text("aa", rnd) for _ in range(20)] + [text("bb", rnd) for _ in range(20)]
    docs = frame(spark, texts, langs=["aa"] * 20 + ["bb"] * 20)
    model = languages.fit(docs)
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z")).withColumn("doc_id", F.col("doc_id") + 5)
    a = [tuple(r)[1:] for r in languages.predicted(docs, model).orderBy("doc_id").collect()]
    assert a == [tuple(r)[1:] for r in languages.predicted(other, model).orderBy("doc_id").collect()]


def test_empty_and_unlabelled(spark):
    empty = frame(spark, [])
    model = languages.fit(empty)
    assert languages.predicted(empty, model).count() == 0
    assert languages.predicted(frame(spark, ["abc", None]), model).select("lang_pred").distinct().collect()[0][0] == "und"
    nothing = languages.fit(frame(spark, ["abc", None, "def"], langs=[None, "en", None]))
    assert nothing.languages == []


@pytest.mark.parametrize("value", [None, "", "123 !?", "\x00"])
def test_no_letters(value):
    assert languages.gram_counts(value) is None


def test_fold_is_the_crc_of_the_id(spark):
    from zlib import crc32

    rows = frame(spark, ["a"] * 50).select("doc_id", languages.held_out().alias("h")).collect()
    assert all(r["h"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_equal_to_a_plain_centroid_search(spark):
    import math

    rnd = random.Random(7)
    langs = [rnd.choice(sorted(LETTERS)) for _ in range(120)]
    docs = frame(spark, [text(x, rnd, 12) for x in langs] + odd_texts(), langs=langs + ["aa"] * len(odd_texts()))
    model = languages.fit(docs)
    rows = {r["doc_id"]: r for r in languages.predicted(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        counts = languages.gram_counts(r["text"])
        if counts is None:
            assert rows[r["doc_id"]]["lang_pred"] == "und"
            continue
        vector = [math.sqrt(c) * w for c, w in zip(counts.tolist(), model.idf.tolist())]
        length = math.sqrt(sum(x * x for x in vector))
        cosines = [sum(x * c for x, c in zip(vector, centre)) / length for centre in model.centroids.tolist()]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert rows[r["doc_id"]]["lang_pred"] == model.languages[best] and abs(rows[r["doc_id"]]["score"] - max(0, cosines[best])) < 1e-9


def test_grams_are_those_of_a_plain_count():
    for value in ("Hello, World!", "é", "a1b", "日本 語"):
        line, kept = " ", False
        for ch in value.lower():
            if ch.isalpha():
                line += ch
                kept = True
            elif line[-1] != " ":
                line += " "
        line = line if line.endswith(" ") else line
        counts = languages.gram_counts(value)
        grams = sum(len(line + " ") - n for n in range(3)) if kept else 0
        assert int(counts.sum()) == grams

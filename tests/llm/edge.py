"""Small documents with every odd case, and helpers of the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank double, node string, row int, tid string, ids string, copies int, n_words int, n_tokens int, tokens string, data string, draw string"


def frame(spark, texts, sources=None, ids=None, langs=None):
    """Documents with extra columns whose names clash with those that operators use inside."""
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        rows.append((doc_id, text, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i], len(text or ""), 7, 0.5, "x", 1, "t", "i", 2, 3, 4, "k", "d", "w"))
    return spark.createDataFrame(rows, SCHEMA)


def prose(n, seed=0, vocabulary=400):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghiklmnoprstuéß") for _ in range(rnd.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def odd_texts():
    long = prose(30_000, 5)
    return [None, "", " \t\n\r\x0b\x0c", "a", "one two", long, long, "same words again", "same words again", "日本語 テキスト 😀", "\x00x\x00", prose(300, 1), "ünïcödé ▁ text  with   runs" + " " * 40]

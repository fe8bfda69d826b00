import re
from collections import Counter

from edge import frame, odd_texts, prose

from trailmill.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_measures_equal_brute_force(spark):
    block = "w1 w2 w3 w4 w5 w6 w7 w8 w9"
    texts = [t for t in odd_texts() if len(t or "") < 50_000] + [
        f"{block} x {block}", f"{block}\n{block}\n\n \n{block}\r\n", "a " * 30, "the of\n" * 12, "## | <b> $5 & %", " ".join([prose(50, 2)] * 3),
    ]
    rows = {r["doc_id"]: r for r in quality.judged(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == brute(t), (t, got)
        assert r["base_failed"] == (got[0] < 20 or 100 * got[4] > 30 * got[0]) and not (r["kept"] and r["base_failed"])


def test_verdicts(spark):
    good = "the cat and the dog went to a house in the north of that town " * 1 + prose(40, 3) + " of the"
    texts = [good, " ".join(w + "###" for w in good.split()), " ".join(w.upper() + "!!" for w in good.split()), None]
    docs = frame(spark, texts)
    assert [r["kept"] for r in quality.judged(docs).orderBy("doc_id").collect()] == [True, False, False, False]
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and [r["text"] for r in kept.collect()] == [good]


def test_bounds_follow_the_table(spark):
    docs = frame(spark, [prose(50, 3)])
    strict = [("mean_word_length", "word_chars", "n_words", 50.0, None)]
    open_table = [("mean_word_length", "word_chars", "n_words", None, None)]
    assert quality.judged(docs, open_table).first()["kept"] and not quality.judged(docs, strict).first()["kept"]


def test_long_repeats_and_empty_table(spark):
    rows = quality.judged(frame(spark, [prose(30_000, 5), "x y " * 20_000])).orderBy("doc_id").collect()
    assert rows[1]["n_repeat_words"] == 40_000 and rows[0]["n_repeat_words"] == 0
    assert quality.judged(frame(spark, [])).count() == quality.accepted(frame(spark, [])).count() == 0


def test_no_user_functions(spark):
    plan = quality.judged(frame(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("PythonUDF", "EvalPython", "MapIn", "Pandas"))

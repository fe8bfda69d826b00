"""Quality rules: a table of thresholds compiled into one projection, without user functions.

A word is a maximal run of characters that are no blank (space, tab, line feed, vertical tab, form
feed, carriage return). Measures of a text: its words and their characters, symbols, exclamation marks,
stop words, lines with a word that repeat an earlier line, and words inside 8-word windows that occur
twice or more (the first occurrence included). The rules are bounds of ratios of these.

Defined cases: a null or blank text has no words, lines or symbols and fails the base rule; rows are
judged one by one, so repeated rows get equal verdicts; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.tables import BLANKS, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with be by as this are at from or an not have "
    "de la le et les des en un du une que pour est qui dans par sur pas au avec il "
    "der die und den von zu das mit sich auf für ist nicht im dem ein eine als auch "
    "el y los se del las por no con su para es al lo"
).split()

#: name, numerator, denominator, least, most; None leaves a side open.
THRESHOLDS = [
    ("mean_word_length", "word_chars", "n_words", 2.5, 12.0),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    ("marks_per_word", "n_marks", "n_words", None, 0.3),
    ("stop_word_share", "n_stop_words", "n_words", 0.02, None),
    ("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.45),
]


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(tokens: Column) -> Column:
    """Number of words inside windows of ``WINDOW`` words that occur at least twice."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, F.lit(WINDOW))))

    def covered(positions: Column) -> Column:
        steps = F.transform(
            positions, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(pairs: Column) -> Column:
        same = lambda e, k: F.get(pairs, k)["h"] == e["h"]
        hits = F.filter(pairs, lambda e, k: F.coalesce(same(e, k - 1), F.lit(False)) | F.coalesce(same(e, k + 1), F.lit(False)))
        return let(F.sort_array(F.transform(hits, lambda e: e["i"])), covered)

    def ordered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(pairs, repeated))

    return F.when(F.size(tokens) < WINDOW, 0).otherwise(let(hashes, ordered))


def measures(text: Column) -> Column:
    """Struct of the counts that the thresholds divide, from one split into words and one into lines."""
    given = F.coalesce(text, F.lit(""))
    full_lines = F.filter(F.split(given, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)

    def counted(tokens: Column) -> Column:
        return let(
            full_lines,
            lambda lines: F.struct(
                F.size(tokens).cast("long").alias("n_words"),
                F.length(F.translate(given, BLANKS, "")).cast("long").alias("word_chars"),
                count_of(given, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                repeated_words(tokens).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                count_of(given, "!?").cast("long").alias("n_marks"),
                F.size(F.filter(tokens, lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            ),
        )

    return let(words(text), counted)


def compiled(value, thresholds=THRESHOLDS) -> Column:
    """True where every ratio is inside its bounds; ``value`` gives the column of a measure."""
    verdict = F.lit(True)
    for _, part, whole, least, most in thresholds:
        if least is not None:
            verdict &= value(part) >= F.lit(least) * value(whole)
        if most is not None:
            verdict &= value(part) <= F.lit(most) * value(whole)
    return verdict


def base_failed(value) -> Column:
    few, repeats = value("n_words") < MIN_WORDS, 100 * value("n_repeat_words")
    return few | (repeats > MAX_REPEAT_PERCENT * value("n_words"))


def judged(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row of ``docs``."""
    measured = docs.select("doc_id", measures(F.col("text")).alias("_m")).select("doc_id", "_m.*")
    failed = measured.withColumn("base_failed", base_failed(F.col))
    return failed.withColumn("kept", ~F.col("base_failed") & compiled(F.col, thresholds))


def accepted(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Rows of ``docs``, columns unchanged, that pass the base rule and every threshold."""

    def verdict(m: Column) -> Column:
        return ~base_failed(m.getField) & compiled(m.getField, thresholds)

    return docs.where(let(measures(F.col("text")), verdict))

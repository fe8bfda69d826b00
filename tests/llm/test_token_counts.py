import random

import public_tokenizers
import sentencepiece
from edge import frame, odd_texts, prose

from trailmill.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\n", "▁", "é", "日本", "the ", "ing", "\t", "!", "    ", "1", "😀", " " * 15, "\x00", "ﬁ", "un", "er", "\xa0"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library_for_any_chunking():
    own, other, rnd = token_counts.compiled(MODEL), library(), random.Random(3)
    for _ in range(3000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        assert {own.tokens(text, chunk) for chunk in (1, 3, 7, 65_536)} == {len(other.encode(text))}, text


def test_runs_of_spaces_and_long_texts():
    own, other = token_counts.compiled(MODEL), library()
    for text in [" " * n for n in range(100)] + ["x" + " " * 40 + "the", prose(4000, 2), "a" * 3000]:
        assert own.tokens(text, 500) == own.tokens(text) == len(other.encode(text))


def test_chunk_maps_compose_in_any_grouping():
    own, text = token_counts.compiled(MODEL), prose(300, 8)
    a, b, c = (own.chunk_map(x) for x in (text[:500], text[500:510], text[510:]))
    assert own.composed(own.composed(a, b), c) == own.composed(a, own.composed(b, c))


def test_states_and_words_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 10)
    own, text = token_counts.Transducer({k: v for k, v in token_counts.compiled(MODEL).scores.items()}), prose(500, 4)
    assert own.tokens(text) == len(library().encode(text))


def test_odd_documents(spark):
    texts, other = odd_texts(), library()
    ids = [None if i == 3 else i for i in range(len(texts))]
    rows = token_counts.token_counts(frame(spark, texts, ids=ids), MODEL, limit=100).collect()
    want = [(i, len((t or "").encode()), n := len(other.encode(t or "")), n > 100) for i, t in zip(ids, texts)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, []), MODEL).count() == 0


def test_long_texts_without_blanks(spark):
    other = library()
    texts = ["".join(chr(0x4E00 + i * 7 % 20_000) for i in range(100_000)), "😀🎉" * 30_000, "$€£" * 20_000, "the" * 50_000, "ab  " + "ba" * 5_000]
    rows = token_counts.token_counts(frame(spark, texts), MODEL).collect()
    assert [r["n_tokens"] for r in sorted(rows)] == [len(other.encode(t)) for t in texts]

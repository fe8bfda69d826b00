import base64
import hashlib
import random

import public_tokenizers as P
import tiktoken
from edge import frame, odd_texts, prose

from trailmill.llm import bpe

FILE = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_chunks_stitch_to_the_same_pieces():
    own, rnd = bpe.codec(FILE, P.PATTERN), random.Random(4)
    parts = ["a", "B", "'", "'re", "'s", " ", "  ", "\n", "\n\n ", "é", "日本", "12", "!?", "\t", "re", "ll", "😀", "x" * 30, " " * 30]
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        want = own.pattern.findall(text)
        for chunk, overlap in ((12, 6), (20, 8), (40, 5)):
            assert bpe.stitched(own.pattern, text, chunk, overlap) == want, text


def test_runs_longer_than_chunks():
    own = bpe.codec(FILE, P.PATTERN)
    for text in ("x" * 500, " " * 500 + "y", "ab " * 50 + "z" * 300 + " 12" * 40, "'" * 200):
        assert bpe.stitched(own.pattern, text, 64, 16) == own.pattern.findall(text)


def test_odd_documents_equal_the_library(spark, monkeypatch):
    texts = odd_texts() + ["<|endoftext|> it's we'll", prose(20_000, 9)]
    ids, other = [None if i == 4 else i for i in range(len(texts))], library()
    rows = bpe.digests(frame(spark, texts, ids=ids), FILE, P.PATTERN).collect()
    want = []
    for i, t in zip(ids, texts):
        tokens = other.encode_ordinary(t or "")
        sha = hashlib.sha256
        want.append((i, len(tokens), sha(",".join(map(str, tokens)).encode()).hexdigest(), sha((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.digests(frame(spark, []), FILE, P.PATTERN).count() == 0


def test_ids_are_an_output_of_their_own(spark):
    rows = bpe.encoded(frame(spark, ["Hello there"]), FILE, P.PATTERN, 65_536, 512)
    row = rows.first()
    assert bpe.decoded(rows, FILE, P.PATTERN).first()["bytes"] == b"Hello there"
    assert row["ids"] == library().encode_ordinary("Hello there")


def test_pieces_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    own = bpe.Codec(FILE, P.PATTERN)
    assert own.encode(prose(200, 6)) == library().encode_ordinary(prose(200, 6))


def test_long_runs_without_a_boundary():
    own, other = bpe.codec(FILE, P.PATTERN), library()
    for text in ("日本語" * 3_000, "x" * 20_000, "".join(chr(0x4E00 + i * 7 % 9_000) for i in range(20_000)), "😀🎉" * 4_000):
        ids = own.encode(text)
        assert ids == other.encode_ordinary(text) and own.decode(ids) == text.encode()

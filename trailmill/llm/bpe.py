"""Byte-level BPE encoding and decoding.

A text is cut into overlapping chunks and each chunk is pre-tokenised on its own. The pattern only looks
forward, so two scans that share a boundary share all later ones: neighbouring chunks are stitched at
the first boundary inside the overlap that both found, and where there is none the earlier scan goes on until it meets one.
The pieces are then encoded by merges in the order of their ranks, those of some neighbouring texts together in numpy, and a
worker keeps the ids of short pieces up to a bound. Decoding joins the bytes of the ids.

Rows are encoded and decoded in one pass over Arrow batches, so a worker holds the tokens of a few texts. Chunks of a text
are scanned in the task that holds it.

Defined cases: a null text counts as empty and has no ids; an empty table gives no rows; rows are encoded one by one, so
repeated rows and null ids are fine; a text of any length goes chunk by chunk, and a run of letters without
a boundary is one piece, merged in n log n steps; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trailmill.llm.merges import merged
from trailmill.llm.tables import mapped

CHUNK = 65_536
OVERLAP = 512
#: Characters before the end of a chunk where a longer text could still change a match.
MARGIN = 4
#: Bounds of what a worker keeps: this many pieces of at most this many characters, below 40 MB.
MAX_PIECES = 150_000
KEPT_CHARS = 24
#: Characters of texts that are encoded together.
GROUP_CHARS = 400_000
#: Pieces of more bytes are merged one by one, in n log n steps.
LONG = 64
NEVER = np.int64(1) << 30


def scan(pattern: regex.Pattern, text: str, begin: int, end: int) -> list[int]:
    """Boundaries that ``pattern`` finds from ``begin`` on and that the text beyond ``end`` cannot change."""
    last = end if end >= len(text) else end - MARGIN
    found = [begin]
    for match in pattern.finditer(text, begin, min(end, len(text))):
        if match.end() > last:
            break
        found.append(match.end())
    return found


def stitched(pattern: regex.Pattern, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Pre-tokens of a whole text from scans of its chunks."""
    if len(text) <= chunk:
        return pattern.findall(text)
    scans = [scan(pattern, text, at, at + chunk) for at in range(0, len(text), chunk - overlap)]
    bounds = scans[0]
    for later in scans[1:]:
        begins = set(later)
        at = bisect_left(bounds, later[0])
        common = next((b for b in bounds[at:] if b in begins), None)
        while common is None and bounds[-1] < later[-1]:
            bounds.append(pattern.match(text, bounds[-1]).end())
            common = bounds[-1] if bounds[-1] in begins else None
        if common is not None:
            del bounds[bisect_left(bounds, common) :]
            bounds += later[bisect_left(later, common) :]
    while bounds[-1] < len(text):
        bounds.append(pattern.match(text, bounds[-1]).end())
    return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


class Merges:
    """All merges of a rank table as pairs of ids, and many short pieces merged at once in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [bytes([i]) for i in range(256)]
        self.first = np.array([ranks.get(x, -1) for x in self.single], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.of_bytes = np.array([ranks.get(a + b, NEVER) for a in self.single for b in self.single], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of neighbours, ``NEVER`` where they are no piece."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], NEVER)

    def one(self, data: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        return tuple(map(self.ranks.__getitem__, merged([self.single[b] for b in data], self.ranks)))

    def many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece. In every round each piece that can merge makes its next merge: lowest rank, then leftmost."""
        out: list = [self.one(p) if len(p) > LONG or len(p) < 2 else self.ranks.get(p) for p in pieces]
        todo = [i for i, found in enumerate(out) if found is None]
        out = [(found,) if isinstance(found, int) else found for found in out]
        if not todo or not len(self.keys):
            for i in todo:
                out[i] = self.one(pieces[i])
            return out
        sizes = np.array([len(pieces[i]) for i in todo])
        data = np.frombuffer(b"".join([pieces[i] for i in todo]), dtype=np.uint8)
        ids = self.first[data]
        piece = np.repeat(np.arange(len(todo)), sizes)
        ranks = np.full(len(ids), NEVER)
        pairs = data[:-1].astype(np.int64) << 8 | data[1:]
        ranks[:-1] = np.where(piece[1:] == piece[:-1], self.of_bytes[pairs], NEVER)
        while len(ids):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), starts)
            ready = best >> 32 == NEVER
            if ready.any():
                lengths = np.diff(np.append(starts, len(ids)))
                keep = np.repeat(~ready, lengths)
                flat, begin = ids[~keep].tolist(), 0
                for i, size in zip(piece[starts[ready]].tolist(), lengths[ready].tolist(), strict=True):
                    out[todo[i]] = tuple(flat[begin : begin + size])
                    begin += size
                moved = np.cumsum(keep) - 1
                ids, piece, ranks, best = ids[keep], piece[keep], ranks[keep], best[~ready]
                if not len(ids):
                    break
                at = moved[best & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            ids[at] = best >> 32
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ranks[at] = ranks[at + 1]  # the pair behind the merged one, ranked anew below
            ids, piece, ranks = ids[keep], piece[keep], ranks[keep]
            at -= np.arange(len(at))
            for left in (at[at > 0] - 1, at[at < len(ids) - 1]):
                left = left[piece[left] == piece[left + 1]]
                ranks[left] = self.rank(ids[left], ids[left + 1])
            last = at[(at == len(ids) - 1) | (piece[at] != piece[np.minimum(at + 1, len(ids) - 1)])]
            ranks[last] = NEVER
        return out


class Codec:
    """Texts to ids by merge ranks, and ids to bytes."""

    def __init__(self, ranks_file: str, pattern: str):
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = Merges(ranks)
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.names = [str(i) for i in range(len(self.bytes_of))]
        self.pieces: dict[str, tuple[int, ...]] = {}

    def encode_all(self, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[list[int]]:
        """Ids of every text; pieces that are not known yet are merged together."""
        rows = [stitched(self.pattern, text, chunk, overlap) for text in texts]
        held = set().union(*rows)
        new = list(held.difference(self.pieces))
        if len(self.pieces) + len(new) > MAX_PIECES:
            self.pieces = {}
            new = list(held)
        self.pieces.update(zip(new, self.merges.many([p.encode() for p in new]), strict=True))
        out = [list(chain.from_iterable(map(self.pieces.__getitem__, row))) for row in rows]
        for piece in new:
            if len(piece) > KEPT_CHARS:
                del self.pieces[piece]
        return out

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        return self.encode_all([text], chunk, overlap)[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def groups(texts: pa.Array, chars: int):
    """Lists of neighbouring texts of about so many characters together; null becomes empty."""
    held, size = [], 0
    for value in texts:
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> Codec:
    return Codec(ranks_file, pattern)


def coded(
    docs: DataFrame, ranks_file: str, pattern: str, with_ids: bool, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with n_tokens, digests of the ids and of the bytes they decode to, and on request the ids, for ``text``."""

    def work(texts: pa.Array) -> list:
        own = codec(ranks_file, pattern)
        out: list[list] = [[], [], []]
        kept: list[np.ndarray] = []
        for group in groups(texts, GROUP_CHARS):
            for ids in own.encode_all(group, chunk, overlap):
                joined = ",".join(map(own.names.__getitem__, ids)).encode()
                row = (len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest())
                for column, x in zip(out, row, strict=True):
                    column.append(x)
                if with_ids:
                    kept.append(np.array(ids, dtype=np.int32))
        if not with_ids:
            return out
        ends = np.cumsum([0, *map(len, kept)], dtype=np.int64).astype(np.int32)
        flat = np.concatenate(kept) if kept else np.zeros(0, dtype=np.int32)
        return [*out, pa.ListArray.from_arrays(ends, flat)]

    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return mapped(docs, "text", work, added | ({"ids": "array<int>"} if with_ids else {}))


def digests(
    docs: DataFrame, ranks_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded again."""
    return coded(docs.select("doc_id", "text"), ranks_file, pattern, False, chunk, overlap)


def encoded(
    docs: DataFrame, ranks_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_tokens, both digests and ids (array of int) of every row."""
    return coded(docs.select("doc_id", "text"), ranks_file, pattern, True, chunk, overlap)


def decoded(tokens: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id and bytes of every row with ids; null ids give null."""

    def work(column: pa.Array) -> list:
        own = codec(ranks_file, pattern)
        return [[None if ids is None else own.decode(ids) for ids in (x.as_py() for x in column)]]

    return mapped(tokens.select("doc_id", "ids"), "ids", work, {"bytes": "binary"})

"""Word shingles of whole texts as 64-bit hashes, in numpy over the bytes of an Arrow column.

A word is a run of bytes other than blanks; its hash is a sum of weighted byte codes taken from running sums,
so all words of a block of rows are hashed at once. Blocks hold about ``BLOCK`` bytes; a longer text is cut
at blanks, so memory does not grow with it beyond its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
STEP = 0x9E3779B97F4A7C15
BLANKS = np.array([9, 10, 11, 12, 13, 32])
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[BLANKS] = False
LOWER = np.arange(256)
LOWER[65:91] += 32
CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and its inverse modulo 2 ** 64 for i below ``size``."""
    if len(_powers.get("up", ())) < size:
        size = max(size, BLOCK + (1 << 12))
        for name, base in (("up", STEP), ("down", pow(STEP, -1, 1 << 64))):
            row = np.full(size, np.uint64(base))
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, begins: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first positions of the words of ``data``; rows start at ``begins``."""
    inside = IN_WORD[data]
    goes_on = inside[1:] & inside[:-1]
    at = begins[(begins > 0) & (begins < len(data))]
    goes_on[at - 1] = False
    starts = np.flatnonzero(inside & ~np.concatenate([[False], goes_on]))
    ends = np.flatnonzero(inside & ~np.concatenate([goes_on, [False]])) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text, cut before blanks."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            blanks = np.flatnonzero(~IN_WORD[data[at + 1 : end + 1]])
            if len(blanks):
                end = at + 1 + int(blanks[-1])
            else:
                while end < len(data) and IN_WORD[data[end]]:
                    end += 1
        yield data[at:end]
        at = end


def words_of(column: pa.Array, lower: bool = True) -> Iterator[np.ndarray]:
    """Word hashes of every row of a string column, in order; none for null."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    codes = CODES[LOWER] if lower else CODES
    none, row = np.zeros(0, dtype=np.int64), 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1)
        part = data[offsets[row] : offsets[last]]
        if last == row + 1 and len(part) > BLOCK:
            yield np.concatenate([word_hashes(x, none, codes)[0] for x in pieces(part)])
        else:
            begins = offsets[row:last] - offsets[row]
            hashes, starts = word_hashes(part, begins, codes)
            bounds = np.append(np.searchsorted(starts, begins), len(starts))
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield hashes[a:b]
        row = last


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of ``width`` words; of fewer words the whole sequence is one."""
    if not len(words):
        return words
    size = min(width, len(words))
    many = len(words) - size + 1
    total = np.full(many, np.uint64(size))
    for k in range(size):
        total = total * np.uint64(STEP) + words[k : k + many]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_sets(column: pa.Array, width: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    for words in words_of(column, lower):
        yield distinct(shingles(words, width))


def set_hash(tokens: np.ndarray) -> int:
    """Signed 64-bit hash of a set of hashes."""
    total = np.uint64(len(tokens)) + np.sum(mix(tokens), dtype=np.uint64)
    return int(mix(np.array([total]))[0].astype(np.int64))

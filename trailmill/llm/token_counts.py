"""Token counts by a finite-state transducer compiled from a piece vocabulary.

In byte-pair merging by score, the encoding of a prefix of a text is the encoding of a shorter prefix plus
one piece, and which piece only depends on the last characters and on the last pieces there. So a
deterministic transducer reads a text from left to right; each transition is annotated with
the number of tokens it adds (negative where pieces grow together). States are made when first
met and kept per worker up to a bound, beyond which they are made again; results do not depend on it.

Line feeds and the start of a run of spaces are points where no piece continues: whatever state enters, the
same state leaves. A chunk of text therefore maps an entering state to a leaving one by a head (what stands
before its first such point), a fixed count, and a tail. These maps compose associatively, and
a prefix scan over the chunks of a text composes them in doubling steps.

Defined cases: a null text counts as empty, with 0 tokens; an empty table gives no rows; rows are counted one by one, so
repeated rows and null ids are fine; a text of any length is read chunk by chunk, with or without blanks; other columns are not read.
"""

from __future__ import annotations

import gc
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.llm.merges import merged
from trailmill.llm.tables import mapped

SPACE = "▁"
CHUNK = 65_536
MAX_STATES = 200_000
MAX_WORDS = 400_000
#: Longer words are counted again each time, so what a worker keeps is bounded in bytes too.
KEPT_CHARS = 32
RUN = re.compile(r"( *)([^ ]*)")


class State(dict):
    """Transitions of a state, by character: the next state and the tokens it adds; made when first asked for.

    A state holds the longest suffix that begins a piece, and for each position in it where a piece may
    yet begin the last piece of the encoding up to there and its token count, relative to the current one.
    """

    __slots__ = ("owner", "window", "last", "counts")

    def __init__(self, owner: Transducer, window: str, last: tuple, counts: tuple):
        self.owner, self.window, self.last, self.counts = owner, window, last, counts

    def __missing__(self, char: str) -> tuple[State, int]:
        move = self[char] = self.owner.compile_move(self, char)
        return move


class Transducer:
    """Transitions ``state, character -> state, added tokens`` of a vocabulary of scored pieces."""

    def __init__(self, scores: dict[str, float], longest_run: int = 16):
        self.scores = scores
        self.order = {piece: -score for piece, score in scores.items()}
        self.prefixes = {p[:i] for p in scores for i in range(1, len(p) + 1)}
        self.pairs = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}  # no piece crosses another pair
        self.longest = max(map(len, scores), default=1)
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.longest_run = longest_run
        self.runs: dict[int, int] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all states but the first, which knows only that a segment starts."""
        for state in getattr(self, "states", {}).values():
            state.clear()  # states name each other
        self.start = State(self, "", (None,), (0,))
        self.states: dict[tuple, State] = {}
        self.words: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a string by the merges themselves, best score first, then leftmost."""
        return merged(text, self.order)

    def fit(self, left: str | None, right: str) -> bool:
        """Whether ``right`` stays a piece of its own after the piece ``left``."""
        if left is None:
            return True
        key = (left, right)
        known = self.neighbours.get(key)
        if known is None:
            known = self.neighbours[key] = self.merged(left + right) == [left, right]
        return known

    def compile_move(self, state: State, char: str) -> tuple[State, int]:
        """The transition of a state on a character."""
        scores, prefixes, last = self.scores, self.prefixes, state.last
        if char not in scores:
            return self.start, len(char.encode("utf-8", "surrogatepass"))  # single bytes, which never merge
        text = state.window + char
        size = len(text)
        for at in range(size):
            piece = text[at:]
            if piece in scores and self.fit(last[at], piece):
                break  # the longest piece that may stand here is the last one
        added = state.counts[at] + 1
        begin, pieces, counts = -1, [], []
        for at in range(size):
            if text[at:] in prefixes:
                begin = at if begin < 0 else begin
                pieces.append(last[at])
                counts.append(state.counts[at] - added)
            elif begin >= 0:
                pieces.append("")
                counts.append(0)
        key = (text[begin:], *pieces, piece, *counts)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = State(self, text[begin:], (*pieces, piece), (*counts, 0))
        return target, added

    def count(self, segment: str) -> int:
        """Tokens of a segment, from the first state."""
        state, total = None, 0
        for at in range(0, len(segment), CHUNK):
            if len(self.states) > MAX_STATES:
                self.clear()  # the state in hand stays usable, as it makes its transitions anew
            state = state or self.start
            for char in segment[at : at + CHUNK]:
                state, added = state[char]
                total += added
        return total

    def first_is_space(self, word: str) -> bool:
        """Whether the space before a word stays a piece of its own.

        No merge crosses a pair of characters that no piece holds, so the pieces up to the first such pair
        are those of the whole; it is enough to merge these characters.
        """
        end = next((i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.pairs), len(word))
        return self.merged(SPACE + word[:end])[0] == SPACE

    def run_tokens(self, spaces: int) -> int:
        """Tokens of a run of spaces alone; the longest run piece repeats."""
        whole, rest = divmod(spaces, self.longest_run)
        if rest not in self.runs:
            self.runs[rest] = len(self.merged(SPACE * rest)) if rest else 0
        return whole + self.runs[rest]

    def word(self, word: str) -> int:
        """Tokens of a space and a word; characters at its end that no piece joins to the one before count alone."""
        found = self.words.get(word)
        if found is None:
            end = len(word)
            while end > 1 and word[end - 2 : end] not in self.pairs:
                end -= 1
            found = self.count(SPACE + word[:end]) + sum(map(self.count, word[end:]))
            if len(word) <= KEPT_CHARS:
                if len(self.words) >= MAX_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found

    def line(self, line: str) -> int:
        """Tokens of a text without line feeds that begins in the first state."""
        head, *words = line.split(" ")
        total = self.count(head)
        if "" not in words:
            return total + sum(map(self.word, words))
        for spaces, word in RUN.findall(line[len(head) :]):
            if not word:
                total += self.run_tokens(len(spaces))
            elif len(spaces) == 1:
                total += self.word(word)
            else:
                joined = self.first_is_space(word)
                total += self.run_tokens(len(spaces) - (not joined)) + self.word(word) - joined
        return total

    def lines(self, text: str) -> int:
        """Tokens of a text that begins in the first state; a line feed is one byte token."""
        parts = text.split("\n")
        return sum(map(self.line, parts)) + len(parts) - 1

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """Head, count and tail of a chunk; the count is None where nothing fixes the state."""
        first = re.search(r"\n|(?<=[^ \n]) ", text)
        if not first:
            return text, None, ""
        begin = first.start()
        end = max(text.rfind("\n"), max((m.start() for m in re.finditer(r"(?<=[^ \n]) ", text[-4096:])), default=-1) + max(0, len(text) - 4096), begin)
        return text[:begin], self.lines(text[begin:end]), text[end:]

    def composed(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if a[1] is None:
            return (a[0] + b[0], *b[1:])
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.lines(a[2] + b[0]) + b[1], b[2]

    def tokens(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text; its chunk maps are composed pairwise until one is left."""
        text = text.replace(SPACE, " ")
        if not text:
            return 0
        if len(text) <= chunk:
            return self.lines(" " + text)
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            pairs = [self.composed(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[len(pairs) * 2 :]
        head, count, tail = maps[0]
        return self.lines(" " + head) + (0 if count is None else count + self.lines(tail))


@lru_cache(maxsize=2)
def compiled(model: str) -> Transducer:
    """Transducer of a sentencepiece BPE model with byte fallback and a dummy prefix."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=model)
    probe = "ﬁ ½  Ａ"
    if pieces.decode(pieces.encode(probe)) != probe:
        raise ValueError("the model changes characters before it splits; the transducer does not")
    kept = {
        pieces.id_to_piece(i): pieces.get_score(i)
        for i in range(pieces.get_piece_size())
        if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i))
    }
    if any(SPACE in p.lstrip(SPACE) for p in kept):
        raise ValueError("pieces with inner spaces need another set of reset points")
    return Transducer(kept, max(len(p) for p in kept if not p.strip(SPACE)))


def token_counts(docs: DataFrame, model: str, limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; the text never leaves the task that read it."""

    def count(texts: pa.Array) -> list:
        transducer = compiled(model)
        on = gc.isenabled()
        gc.disable()  # the many small states would be walked again and again; they are cleared by hand
        try:
            return [[transducer.tokens(t.as_py() or "", chunk) for t in texts]]
        finally:
            if on:
                gc.enable()

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = mapped(docs.select("doc_id", n_bytes.alias("n_bytes"), "text"), "text", count, {"n_tokens": "long"})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

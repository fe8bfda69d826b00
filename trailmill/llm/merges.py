"""Byte-pair merging of a list of parts, used by the tokenizers."""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heapify, heappop, heappush

#: Up to so many parts the best pair is looked up in a list, beyond it in a heap.
SHORT = 96
NEVER = float("inf")


def merged(parts: Sequence, ranks: dict) -> list:
    """``parts`` (strings or bytes) after all merges into pieces of ``ranks``: lowest rank first, then leftmost.

    Long inputs use a heap, so a run of n characters takes n log n steps.
    """
    return listed(list(parts), ranks.get) if len(parts) <= SHORT else heaped(list(parts), ranks.get)


def listed(parts: list, rank) -> list:
    found = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while found:
        best = min(found)
        if best == NEVER:
            break
        at = found.index(best)
        parts[at] += parts.pop(at + 1)
        del found[at]
        if at < len(found):
            found[at] = rank(parts[at] + parts[at + 1], NEVER)
        if at:
            found[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
    return parts


def heaped(parts: list, rank) -> list:
    size = len(parts)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(r, i, x) for i in range(size - 1) if (r := rank(x := parts[i] + parts[i + 1], NEVER)) != NEVER]
    heapify(heap)
    while heap:
        _, i, joined = heappop(heap)
        right = after[i]
        if parts[i] is None or right >= size or parts[i] + parts[right] != joined:
            continue  # one side has grown since
        parts[i], parts[right] = joined, None
        after[i] = after[right]
        if after[i] < size:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < size:
                pair = parts[left] + parts[after[left]]
                if (r := rank(pair, NEVER)) != NEVER:
                    heappush(heap, (r, left, pair))
    return [p for p in parts if p is not None]

"""Byte-pair merging: the lowest-ranked adjacent pair goes first, the leftmost among equals."""

from __future__ import annotations

import heapq
from collections.abc import Callable


def merge(parts: list, rank: Callable) -> tuple[list, int]:
    """Merge ``parts`` with a heap of pairs over a doubly linked list.

    ``rank(joined)`` gives the order of a joined pair, None if the pair never
    merges. Returns the parts left and the number of merges. Entries of the heap
    that an earlier merge made stale are dropped when popped, so the work is
    O(n log n) for a piece of any length.
    """
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        joined = parts[i] + parts[i + 1]
        r = rank(joined)
        if r is not None:
            heap.append((r, i, joined))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, joined = heapq.heappop(heap)
        left = parts[i]
        if left is None:
            continue
        j = after[i]
        if j >= n or len(left) + len(parts[j]) != len(joined) or left + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            joined = parts[i] + parts[k]
            r = rank(joined)
            if r is not None:
                heapq.heappush(heap, (r, i, joined))
        h = before[i]
        if h >= 0:
            joined = parts[h] + parts[i]
            r = rank(joined)
            if r is not None:
                heapq.heappush(heap, (r, h, joined))
    return [p for p in parts if p is not None], merges

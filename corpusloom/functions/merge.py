"""Merging the symbols of one BPE piece: by rank, from left to right."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

SHORT = 32  # up to here scanning a list of ranks is faster than a heap
NONE = (1 << 60, -1)


def merge_ids(ids: list[int], rank: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``ids`` after all merges of ``rank``, {(left, right): (rank, result)}.

    The adjacent pair of the least rank is merged first, of equal ones the leftmost; a result may
    form pairs of any rank.  Ids that ``rank`` does not know stay.  O(n log n) for n symbols: the
    symbols are a linked list over flat arrays, their pairs a heap whose stale entries are passed over.
    """
    n = len(ids)
    if n <= SHORT:
        ids = list(ids)
        ranks = [rank.get(p, NONE) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is NONE:
                break
            i = ranks.index(best)
            ids[i] = best[1]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), NONE)
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NONE)
        return ids
    cur, right, left = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    get = rank.get
    heap = [(r[0], i, a, b) for i, (a, b) in enumerate(zip(cur, cur[1:])) if (r := get((a, b))) is not None]
    heapify(heap)
    while heap:
        _, i, a, b = heappop(heap)
        j = right[i]
        if cur[i] != a or j >= n or cur[j] != b:
            continue  # one of the two has been merged since
        c = cur[i] = get((a, b))[1]
        cur[j] = -2
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := get((c, cur[k]))) is not None:
                heappush(heap, (r[0], i, c, cur[k]))
        h = left[i]
        if h >= 0 and (r := get((cur[h], c))) is not None:
            heappush(heap, (r[0], h, cur[h], c))
    out, i = [], 0
    while i < n:
        out.append(cur[i])
        i = right[i]
    return out

"""Maximal periodic runs of words, by difference-cover LCE.

A run of period q is a stretch in which words q apart are equal, that no neighbouring word extends and that
is no run of a smaller period; here runs of at least four periods and six words.  Texts of a block are laid
end to end with a mark of its own after each, so that no match crosses a text.

* **Harmonic grid.**  The words i with word i = word i + q of a run are at least 3q in a row (five for q = 1), so one of
  them lies on the grid of that step: n / (3q) places for a period q, O(n log n) for all.  Places whose next words do
  not match either are dropped; the others ask how far the match goes to the right and to the left.
* **LCE.**  Only suffixes at positions i with i mod 13 in the difference cover {0, 1, 3, 9} are sorted: windows of 13 words
  get ranks, then ranks 13 * 2^k apart are paired until all differ.  For any (i, j) some d < 13 brings both into the
  cover: d words are compared, then the rest is the least LCP between two ranks, a range minimum from a sparse table.
  Matches to the left are asked of the same structure over the reversed words.

A stretch found with several periods is a run of the smallest: a stretch of four periods q with a smaller period p has
p dividing q, and the same bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.common import blocks, utf8
from corpusloom.llm.words import Polynomials, exact_ids, joined, spans

COVER, V = (0, 1, 3, 9), 13  # every difference modulo 13 is one of two members of the cover
MIN_LENGTH, MIN_PERIODS = 6, 4


def _meeting() -> np.ndarray:
    """For residues a, b: the least d with (a + d) and (b + d) in the cover."""
    inside = np.zeros(V, bool)
    inside[list(COVER)] = True
    return np.array([[next(d for d in range(V) if inside[(a + d) % V] and inside[(b + d) % V]) for b in range(V)]
                     for a in range(V)])


MEET = _meeting()


class Lce:
    """Longest common extensions to the right in an array of ids >= 0 in which each text ends in a mark of its own."""

    def __init__(self, x: np.ndarray):
        self.n = n = len(x)
        top = int(x.max()) + 1 if n else 0
        self.x = np.concatenate([x, np.arange(top, top + 2 * V)])  # marks for what lies behind the end
        inside = np.zeros(V, bool)
        inside[list(COVER)] = True
        at = np.flatnonzero(inside[np.arange(n) % V])
        self.place = np.full(n + 1, -1, np.int64)
        self.place[at] = np.arange(len(at))
        levels = [self._windows(at)]
        step = V
        while len(at) and levels[-1].max() < len(at) - 1:
            r, to = levels[-1], at + step
            then = np.where(to < n, r[self.place[np.minimum(to, n)]] + 1, 0)
            levels.append(np.unique(r * (len(at) + 1) + then, return_inverse=True)[1])
            step *= 2
        self.rank = levels[-1]
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        self._table(at[order[:-1]], at[order[1:]], levels)

    def _windows(self, at: np.ndarray) -> np.ndarray:
        """Ranks of the windows of V words at the sampled positions, several words packed into a key."""
        per = max(1, 63 // max(1, int(self.x.max()).bit_length()))
        bits, keys = 63 // per, []
        for a in range(0, V, per):
            key = np.zeros(len(at), np.int64)
            for d in range(a, min(V, a + per)):
                key = (key << bits) | self.x[at + d]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for k in keys:
            new[1:] |= k[order[1:]] != k[order[:-1]]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _table(self, p: np.ndarray, q: np.ndarray, levels: list[np.ndarray]) -> None:
        """LCPs of neighbours in the order (from the ranks of each level, then word by word), and their range minima."""
        lcp = np.zeros(len(p), np.int64)
        for k in range(len(levels) - 2, -1, -1):
            a, b = np.minimum(p + lcp, self.n), np.minimum(q + lcp, self.n)
            a, b = self.place[a], self.place[b]
            same = (a >= 0) & (b >= 0) & (levels[k][a] == levels[k][b])
            lcp[same] += V << k
        lcp += self._words(p + lcp, q + lcp, np.full(len(p), V))[0]
        self.table = [lcp]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            t, h = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-h], t[h:]))

    def _words(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from i and j on, up to ``most`` (at most V); whether all of them are equal."""
        got, alive = np.zeros(len(i), np.int64), np.ones(len(i), bool)
        for d in range(V):
            alive &= (d < most)
            alive[alive] = self.x[i[alive] + d] == self.x[j[alive] + d]
            if not alive.any():
                break
            got += alive
        return got, got == most

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from i and from j on (i != j)."""
        d = MEET[i % V, j % V]
        got, on = self._words(i, j, d)
        on &= (i + d < self.n) & (j + d < self.n)
        a, b = self.rank[self.place[(i + d)[on]]], self.rank[self.place[(j + d)[on]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((high - low).astype(float))[1] - 1  # floor of the logarithm
        least = np.empty(len(a), np.int64)
        for level in np.unique(k):
            m, t = k == level, self.table[level]
            least[m] = np.minimum(t[low[m]], t[high[m] - (1 << int(level))])
        got[on] += least
        return got


def _grid(x: np.ndarray, reach: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, q) of the harmonic grid whose words match, as do two of the words next to them.

    ``reach`` has (q, end): texts of at least four periods q end before ``end``.
    """
    at, period = [], []
    pad = np.concatenate([np.array([-1, -2]), x, np.array([-3, -4])])  # two words on either side that match nothing
    for q, end in reach:
        i = np.arange(0, end - q, max(3 * q, 5))
        i = i[x[i] == x[i + q]]
        if len(i):
            left = pad[i + 1] == pad[np.minimum(i + 1 + q, len(pad) - 1)]
            right = pad[i + 3] == pad[np.minimum(i + 3 + q, len(pad) - 1)]
            left2 = pad[i] == pad[np.minimum(i + q, len(pad) - 1)]
            right2 = pad[i + 4] == pad[np.minimum(i + 4 + q, len(pad) - 1)]
            i = i[(left & right) | (left & left2) | (right & right2)]
        at.append(i)
        period.append(np.full(len(i), q, np.int64))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(at + none), np.concatenate(period + none)


def runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``ids`` are the word ids of texts laid end to end, text t's at [bounds[t], bounds[t + 1]).
    """
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] >= MIN_LENGTH]  # long texts first: those that a period can fit are a prefix
    for filtered in (False, True):
        m = n[order]
        begin = np.concatenate([[0], np.cumsum(m + 1)])  # with a mark after each text
        x = np.empty(int(begin[-1]), np.int64)
        words = np.ones(len(x), bool)
        words[begin[1:] - 1] = False
        take = np.repeat(bounds[order] - begin[:-1], m + 1) + np.arange(len(x))
        x[words] = ids[take[words]]
        top = int(ids.max()) + 1 if len(ids) else 0
        x[~words] = top + np.arange(len(order))
        if not filtered:
            fits = np.searchsorted(-m, -MIN_PERIODS * np.arange(1, (int(m[0]) if len(m) else 0) // MIN_PERIODS + 1), side="right")
            at, period = _grid(x, [(q, int(begin[f])) for q, f in enumerate(fits, 1)])
            text = np.searchsorted(begin, at, side="right") - 1
            some = np.unique(text)  # only texts with such places are sorted
            shift = np.searchsorted(some, text)
            at = at - begin[text]
            order = order[some]
        else:
            at = at + begin[shift]
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none
    ahead = Lce(x)(at, at + period)
    size = len(x)
    back = Lce(x[::-1].copy())(size - at, size - at - period) if size else none  # the words before i and i + q
    start, end = at - back, at + period + ahead
    keep = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
    start, end, period = start[keep], end[keep], period[keep]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])  # the smallest period of a stretch
    start, end, period = start[first], end[first], period[first]
    local = np.searchsorted(begin, start, side="right") - 1
    text, start_in, length = order[local], start - begin[local], end - start
    by = np.lexsort((period, start_in, text))
    return text[by], start_in[by], length[by], period[by]


def find_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` without its text, with ``runs`` (array of start, length, period in words, by start and period) and
    ``collapsed``: the words joined by one space, without those that a run contains after its first period.

    Words are runs of characters other than ASCII white space.  Null and empty texts have no runs and an empty text;
    repeated rows get their results each; other columns (null or not) are kept, one of the new names raises ValueError.
    A text is handled whole, in one task.
    """
    keep = [c for c in docs.columns if c != text_col]
    if {runs_col, collapsed_col} & set(keep):
        raise ValueError(f"columns {runs_col} and {collapsed_col} must be new")
    long = pa.int64()
    struct = pa.struct([pa.field(k, long, nullable=False) for k in ("start", "length", "period")])

    def run(batches):
        hashes = Polynomials()
        for b in batches:
            data, off = utf8(b.column(len(keep)))
            for i, j in blocks(off):
                part = data[off[i]:off[j]]
                s, e, doc = spans(part, off[i:j + 1] - off[i])
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                text, start, length, period = runs(exact_ids(part, s, e, hashes.words(part, s, e)), bounds)
                cover = np.zeros(len(s) + 1, np.int64)
                np.add.at(cover, bounds[text] + start + period, 1)
                np.add.at(cover, bounds[text] + start + length, -1)
                kept = np.cumsum(cover)[:-1] == 0
                s, e, doc = s[kept], e[kept], doc[kept]
                first = np.ones(len(s), bool)
                first[1:] = doc[1:] != doc[:-1]
                raw, ends = joined(part, s, e, first)
                cut = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(j - i + 1))]
                at = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(
                    [pa.array(start, long), pa.array(length, long), pa.array(period, long)], fields=list(struct)))
                texts = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes()))
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in b.columns[:-1]] + [found, texts.cast(pa.string())],
                                                 names=[*keep, runs_col, collapsed_col])

    one = T.StructType([T.StructField(k, T.LongType(), False) for k in ("start", "length", "period")])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(runs_col, T.ArrayType(one, False)), T.StructField(collapsed_col, T.StringType())])
    return docs.select(*[f"`{c}`" for c in keep], f"`{text_col}`").mapInArrow(run, schema)

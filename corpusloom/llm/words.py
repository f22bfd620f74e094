"""Words of many texts at once: spans, prefix-polynomial hashes and exact ids, in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd: each power has an inverse modulo 2^64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], _U)  # the first i bytes of eight
LONG = 64  # bytes of a word that are read eight at a time


def byte_table(values) -> np.ndarray:
    """A flag per byte, set for ``values``."""
    t = np.zeros(256, bool)
    t[list(values)] = True
    return t


BLANK = byte_table([9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Polynomials:
    """Prefix polynomials modulo 2^64.  Tables of powers are made when first needed and kept, so a task makes one object."""

    def __init__(self):
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.codes = {b: mix(np.arange(1, 257).astype(_U) * _U(b)) for b in BASES}

    def table(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self.powers or len(self.powers[base][0]) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            up, down = np.full(size, base, _U), np.full(size, pow(base, -1, 1 << 64), _U)
            up[0] = down[0] = 1
            self.powers[base] = np.cumprod(up), np.cumprod(down)
        return self.powers[base]

    def sums(self, codes: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = BASES[0]) -> np.ndarray:
        """Sum of codes[i] * base^(i - s) over i in [s, e): prefix sums, moved back by inverse powers."""
        up, down = self.table(base, len(codes) + 1)
        total = np.zeros(len(codes) + 1, _U)
        np.cumsum(codes * up[:len(codes)], out=total[1:])
        return (total[e] - total[s]) * down[s]

    def words(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = BASES[0]) -> np.ndarray:
        """Hashes of the byte spans [s, e)."""
        return mix(self.sums(self.codes[base][data], s, e, base) + (e - s).astype(_U))

    def short_words(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Other hashes of the byte spans [s, e), none empty: read eight bytes at a time, which costs by word and not by byte; those over LONG bytes by ``words``."""
        n = e - s
        eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
        h = mix((eight[s] & MASKS[np.minimum(n, 8)]) + n.astype(_U) * _U(BASES[0]))
        at, d = np.flatnonzero(n > 8), 8
        while len(at) and d < LONG:
            h[at] = mix(h[at] * _U(BASES[1]) + (eight[s[at] + d] & MASKS[np.minimum(n[at] - d, 8)]))
            d += 8
            at = at[n[at] > d]
        if len(at):
            ends = np.cumsum(n[at])
            h[at] = self.words(data[_places(s[at], n[at])], ends - n[at], ends)
        return h


def spans(data: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not ``blank``) of texts laid end to end, and each word's text."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def _places(s: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of all bytes of spans, one span after another."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(s - (ends - length), length)


def exact_ids(data: np.ndarray, s: np.ndarray, e: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Equal ids for words of equal bytes: by their hashes, every word compared with the first of its hash.

    If two words share a hash, the ids come from the words themselves.
    """
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    length, model = e - s, first[ids]
    if (length == length[model]).all() and (data[_places(s, length)] == data[_places(s[model], length)]).all():
        return ids
    raw, seen = data.tobytes(), {}
    return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(s.tolist(), e.tolist())], np.int64)


def joined(data: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words joined by one space, and the end of each word in them; no space goes before a ``first`` one."""
    length = e - s
    ends = np.cumsum(length + ~first)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    out[_places(ends - length, length)] = data[_places(s, length)]
    return out, ends

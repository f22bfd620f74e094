"""Byte-level BPE (C4-C10, C12 for BPE).

Fitting keeps the corpus distributed as blocks of *distinct pieces* with
their counts.  A round is one Arrow pass over flat symbol arrays, which merges
and counts what remains (once per task), and one ``groupBy`` sum of those partial counts; the
driver picks the next merges.  Only bounded data reaches it: the top ranked
pairs of the round, those of their neighbours that can change the choice, and
the vocabulary itself (at most the target size).

Exact batching: for the pairs ranked next, the pass also counts each neighbour.
From these the driver follows bounds of the counts through several merges and
takes those that merging one pair per round would surely take (``_choose``).

Rules (matching the public ``tokenizers`` BPE trainer with a byte-level
pre-tokenizer): id 0 is ``<unk>``; then the byte symbols seen in the corpus
in code-point order of the symbol; then merges.  Next merge: greatest
weighted count, ties to the smaller (left id, right id).  A merge whose
string already exists re-uses that id.  Unseen bytes encode to one
``<unk>`` each; a literal ``<unk>`` in text is id 0; decoding drops it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.merge import merge_ids
from corpusloom.session import cut_lineage

UNK = "<unk>"

# ---------------------------------------------------------------------------
# Fixed value: the public GPT-2 pre-tokenizer pattern (Java needs (?U) for a
# Unicode-aware \s).
# ---------------------------------------------------------------------------
PRETOKENIZE = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable stand-in for each byte value (the published GPT-2 rule):
    bytes that are printable Latin-1 (``!``..``~``, ``¡``..``¬``, ``®``..``ÿ``)
    stand for themselves; the other 68 bytes take code points 256, 257, ...
    in byte order."""
    keep = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


_SYM = byte_symbols()
_SYM_INV = {s: i for i, s in enumerate(_SYM)}


def to_symbols(piece: str) -> str:
    return "".join(_SYM[b] for b in piece.encode("utf-8"))


def from_symbols(symbols: str) -> bytes:
    return bytes(_SYM_INV[c] for c in symbols)


# ---------------------------------------------------------------------------
# C4, C6
# ---------------------------------------------------------------------------
def pretokenize(c) -> F.Column:
    """C4: pieces of a text, natively (``regexp_extract_all``)."""
    return F.regexp_extract_all(c, F.lit(PRETOKENIZE), 0)


def split_special(c) -> F.Column:
    """Pieces with a literal ``<unk>`` kept whole as its own piece."""
    segs = F.split(c, "<unk>", -1)
    return F.flatten(F.transform(
        segs, lambda s, i: F.concat(F.when(i > 0, F.array(F.lit(UNK))).otherwise(F.array().cast("array<string>")),
                                    pretokenize(s))))


def piece_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct pre-token pieces with their frequency (map-side partial
    aggregation; the special ``<unk>`` is not a piece)."""
    ex = docs.select(F.explode(split_special(F.col(text))).alias("piece"))
    return ex.filter(F.col("piece") != UNK).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Pair counts
# ---------------------------------------------------------------------------
PAIR_SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                            T.StructField("c", T.LongType())])


def _partial_pairs(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        if pdf.empty:
            continue
        arrs = [np.asarray(x, dtype=np.int64) for x in pdf["ids"]]
        lens = np.fromiter((len(x) for x in arrs), dtype=np.int64, count=len(arrs))
        if lens.sum() < 2:
            continue
        flat = np.concatenate(arrs)
        w = np.repeat(pdf["n"].to_numpy(dtype=np.int64), lens)
        ends = np.cumsum(lens) - 1
        last = np.zeros(len(flat), dtype=bool)
        last[ends[lens > 0]] = True
        valid = ~last[:-1]
        keys = (flat[:-1] << 32) | flat[1:]
        keys, wv = keys[valid], w[:-1][valid]
        if len(keys) == 0:
            continue
        uniq, inv = np.unique(keys, return_inverse=True)
        sums = np.bincount(inv, weights=wv).astype(np.int64)
        yield pd.DataFrame({"a": (uniq >> 32).astype(np.int32), "b": (uniq & 0xFFFFFFFF).astype(np.int32),
                            "c": sums})


def pair_counts(pieces: DataFrame) -> DataFrame:
    """Adjacent symbol pairs weighted by piece count: ``(a, b, c)``."""
    return (pieces.select("ids", "n").mapInPandas(_partial_pairs, PAIR_SCHEMA)
            .groupBy("a", "b").agg(F.sum("c").alias("c")))


# ---------------------------------------------------------------------------
# fit
# ---------------------------------------------------------------------------
# The working table holds blocks of pieces: ``ids`` are the int32 symbols of all
# its pieces, each ended by -1, and ``n`` the int64 count of each piece.
BLOCKS = "ids binary, n binary"
ROUND = BLOCKS + ", a int, b int, x int, c long"
PIECES_PER_TASK = 1 << 16      # so many pieces make a task worthwhile,
MOST_PIECES_PER_TASK = 1 << 21  # and so many are the most once every core has a task: a task's counts are shuffled
SUMMED_AT = 1 << 22            # keys that a task holds before it sums them up
_END = -1
_PAIR = -1  # x of a pair's own count; a left neighbour x >= 0, a right neighbour y is -2 - y


def _to_blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        pieces = [p.encode("utf-8") for p in batch.column(0).to_pylist()]
        if not pieces:
            continue
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        flat = np.full(int(ends[-1]) + 1, _END, np.int32)
        inside = np.ones(len(flat), bool)
        inside[ends] = False
        flat[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        n = np.asarray(batch.column(1), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())],
                                         ["ids", "n"])


def _bytes_seen(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for blob in batch.column(0).to_pylist():
            seen = np.unique(np.frombuffer(blob, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(seen[seen != _END], pa.int32())], ["byte"])


def _merged(flat: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    """``flat`` with the pair (a, b) replaced by ``new``; in a run of one symbol every second position matches."""
    at = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b))
    if not len(at):
        return flat
    if a == b:
        first = np.r_[True, np.diff(at) != 1]
        begin = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        at = at[(at - begin) % 2 == 0]
    out = flat.copy()
    out[at] = new
    return np.delete(out, at + 1)


class _Sums:
    """Weights summed by 64-bit keys, added in arrays."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.keys.append(keys)
        self.weights.append(weights)
        self.size += len(keys)
        if self.size >= SUMMED_AT:
            keys, weights = self.total()
            self.keys, self.weights = [keys], [weights]
            self.size = len(keys) // 2  # the sums so far count less: they are summed again only when as many keys came

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        t = (pa.table({"k": np.concatenate(self.keys), "w": np.concatenate(self.weights)})
             .group_by("k", use_threads=False).aggregate([("w", "sum")]))
        return t["k"].to_numpy(), t["w_sum"].to_numpy()


def _places(flat: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``flat`` one of the sorted ``pairs`` (a << 32 | b) stands, and which."""
    if not len(pairs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    (first, i), (second, j) = (np.unique(x, return_inverse=True) for x in (pairs >> 32, pairs & 0xFFFFFFFF))
    row, col = np.zeros((2, max(int(flat.max()), int(first[-1]), int(second[-1])) + 2), np.int32)  # 0, and the end mark's at last: in no pair
    row[first], col[second] = np.arange(1, len(first) + 1) * (len(second) + 1), np.arange(1, len(second) + 1)
    table = np.full((len(first) + 1) * (len(second) + 1), -1, np.int32)
    table[(i + 1) * (len(second) + 1) + j + 1] = np.arange(len(pairs))
    which = table[row[flat[:-1]] + col[flat[1:]]]
    at = np.flatnonzero(which >= 0)
    return at, which[at].astype(np.int64)


def _merge_block(flat: np.ndarray, n: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The block after ``merges``; pieces that none of them changes are copied, the others follow them."""
    at, _ = _places(flat, np.sort(np.array([(a << 32) | b for a, b, _ in merges], np.int64)))
    if not len(at):  # a merge of a new symbol needs another one before it
        return flat, n
    ends = np.flatnonzero(flat == _END)
    hit = np.zeros(len(flat), bool)
    hit[at] = True
    changed = np.logical_or.reduceat(hit, np.r_[0, ends[:-1] + 1])
    inside = np.repeat(changed, np.diff(ends, prepend=-1))
    part = flat[inside]
    for merge in merges:
        part = _merged(part, *merge)
    return np.concatenate([flat[~inside], part]), np.concatenate([n[~changed], n[changed]])


def _round_fn(translate: np.ndarray | None, merges: list[tuple[int, int, int]], watched: list[tuple[int, int]]):
    """One pass over the blocks: merge, drop pieces of one symbol, count the pairs that remain and the
    neighbours of the ``watched`` pairs.  Gives the new blocks and, beside a task's last block, the counts of the
    whole task as rows of one table."""
    watch = np.sort(np.array([(a << 32) | b for a, b in watched], np.int64))

    def rows(flat, n, a, b, x, c):
        none = [None] * len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array([flat.astype(np.int32).tobytes(), *none], pa.binary()), pa.array([n.tobytes(), *none], pa.binary())]
            + [pa.concat_arrays([pa.nulls(1, t), pa.array(v, t)])
               for v, t in ((a, pa.int32()), (b, pa.int32()), (x, pa.int32()), (c, pa.int64()))],
            ["ids", "n", "a", "b", "x", "c"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, left, right, block = _Sums(), _Sums(), _Sums(), None
        for batch in it:
            for ids, counts in zip(batch.column(0), batch.column(1)):
                flat, n = np.frombuffer(ids.as_buffer(), np.int32), np.frombuffer(counts.as_buffer(), np.int64)
                if translate is not None:
                    flat = translate[flat]
                flat, n = _merge_block(flat, n, merges)
                length = np.diff(np.flatnonzero(flat == _END), prepend=-1)  # with the end mark
                long = length > 2
                if not long.any():
                    continue
                flat, n, length = flat[np.repeat(long, length)], n[long], length[long]
                w = np.repeat(n, length)
                at = np.flatnonzero((flat[:-1] != _END) & (flat[1:] != _END))
                own.add((flat[at].astype(np.int64) << 32) | flat[at + 1], w[at])
                at, which = _places(flat, watch)
                for side, other in ((left, np.where(at > 0, flat[at - 1], _END)), (right, flat[at + 2])):
                    there = other != _END
                    side.add((which[there] << 32) | other[there], w[at[there]])
                if block is not None:
                    none = np.zeros(0, np.int64)
                    yield rows(*block, none, none, none, none)
                block = flat, n
        if block is not None:
            pairs, c = own.total()
            cols = [(pairs >> 32, pairs & 0xFFFFFFFF, np.full(len(pairs), _PAIR), c)]
            for side, sums in ((0, left), (1, right)):
                k, c = sums.total()
                pair, x = watch[k >> 32] if len(k) else k, k & 0xFFFFFFFF
                cols.append((pair >> 32, pair & 0xFFFFFFFF, -2 - x if side else x, c))
            yield rows(*block, *(np.concatenate(z) for z in zip(*cols)))

    return run


def _choose(top: list[tuple[int, int, int]], near: dict[tuple[int, int], list[tuple[int, int]]], floor: int,
            tokens: list[str], index: dict[str, int], room: int) -> list[tuple[int, int, int]]:
    """Merges (a, b, new id), in order, that merging one pair at a time would surely make next.

    ``top`` holds the ranked pairs with their counts; no other pair counts more than ``floor``.
    ``near`` holds, for the watched pairs, the count of the pair with each neighbour (x >= 0 on the
    left, -2 - y on the right).  Each pair has a lower and an upper bound of its count, which the
    merges accepted so far move.  The pair of the greatest upper bound is accepted if its lower bound is
    above all other upper bounds, or if its count is exact (then ties are settled by the ids).
    """
    high, low = ({(a, b): c for a, b, c in top} for _ in range(2))
    out: list[tuple[int, int, int]] = []
    fresh: set[str] = set()
    made: dict[int, str] = {}
    used: set[int] = set()  # symbols that an accepted merge has taken from or made
    begins: dict[int, set[int]] = {}  # symbols that a new token begins with, at any depth
    ends: dict[int, set[int]] = {}

    def less(pair, c, exact):
        if pair in high:
            low[pair] = max(0, low[pair] - c)
            high[pair] -= c if exact else 0

    def more(pair, c, exact):
        low[pair] = low.get(pair, 0) + (c if exact else 0)
        high[pair] = high.get(pair, 0) + c

    while high:
        pair = min(high, key=lambda p: (-high[p], p))
        a, b = pair
        others = max((c for p, c in high.items() if p != pair), default=0)
        sure = low[pair] > floor and (low[pair] == high[pair] or low[pair] > others)
        string = (tokens[a] if a < len(tokens) else made[a]) + (tokens[b] if b < len(tokens) else made[b])
        reuse = string in index or string in fresh
        if out and (not sure or reuse) or high[pair] < 1:
            break
        if reuse:
            return [(a, b, index[string])]
        if len(out) >= room:
            break
        new = len(tokens) + len(out)
        out.append((a, b, new))
        fresh.add(string)
        made[new] = string
        most = high.pop(pair)
        low.pop(pair)
        begins[new], ends[new] = {a} | begins.get(a, set()), {b} | ends.get(b, set())
        if pair in near and a != b:
            clean = a not in used and b not in used
            for code, c in near[pair]:
                x = code if code >= 0 else -2 - code
                exact = clean and x not in used and x != a and x != b
                left = code >= 0
                less((x, a) if left else (b, x), c, exact)
                more((x, new) if left else (new, x), c, exact)
                if x == (b if left else a):
                    more((new, new), c, False)
                for t, inner in (ends if left else begins).items():  # tokens of this batch that x may be part of by now
                    if t != new and x in inner:
                        less((t, a) if left else (b, t), c, False)
                        more((t, new) if left else (new, t), c, False)
        else:  # nothing is known of the neighbours: only that they are no more than the pair, nor than their own pairs
            beside = max((c for p, c in high.items() if p[1] == a or p[0] == b), default=0)
            if a == b:  # a run of one symbol: the new token stands beside the symbol, or itself, at every second place at most
                beside = max(beside, most // 2)
            floor = max(floor, min(most, max(beside, floor)))
            for p in low:
                if p[1] == a or p[0] == b:
                    low[p] = 0
        used.update((a, b, new))
    return out


def _neighbours(sums: DataFrame, top: list[tuple[int, int, int]], watched: set[tuple[int, int]],
                floor: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """The neighbours of the watched pairs in ``top`` that ``_choose`` needs.

    A neighbour that counts ``floor`` at most, and whose own pair with the symbol beside it is not in ``top``,
    stays behind: neither that pair nor the one made with the new symbol can count more than ``floor``.
    """
    near = {(a, b): [] for a, b, _ in top if (a, b) in watched}
    if not near:
        return near
    keys = lambda pairs: ", ".join(f"{(a << 32) | b}L" for a, b in pairs)
    rows = (sums.where(F.col("x") != _PAIR).where(F.expr(f"(shiftleft(bigint(a), 32) | b) IN ({keys(near)})"))
            .where((F.col("c") > floor)
                   | F.expr(f"if(x >= 0, shiftleft(bigint(x), 32) | a, shiftleft(bigint(b), 32) | (-2 - x)) IN ({keys((a, b) for a, b, _ in top)})"))
            .select("a", "b", "x", "c").toArrow())
    for a, b, x, c in zip(*(rows.column(i).to_pylist() for i in range(4))):
        near[a, b].append((x, c))
    return near


def fit_bpe(pieces: DataFrame, vocab_size: int, top_n: int = 1024, max_rounds: int | None = None,
            checkpoint_every: int = 16, watch: int = 256) -> tuple[DataFrame, DataFrame, dict]:
    """Fit byte-level BPE on ``pieces(piece, n)`` up to ``vocab_size``.

    Returns ``(vocab(id, token, bytes, type), merges(rank, left, right, new_id),
    info)``.  The vocabulary may end smaller than the target when no pair is
    left.  ``top_n`` (ranked pairs that reach the driver in a round) and
    ``watch`` (pairs whose neighbours the next round counts) change the number
    of rounds, not the result.
    """
    spark = pieces.sparkSession
    pieces = cut_lineage(pieces.select("piece", "n"))
    distinct = pieces.count()
    tasks = max(1, min(-(-distinct // PIECES_PER_TASK),
                       max(spark.sparkContext.defaultParallelism, -(-distinct // MOST_PIECES_PER_TASK))))
    cur = cut_lineage(pieces.repartition(tasks).mapInArrow(_to_blocks, BLOCKS))
    seen = [r["byte"] for r in cur.select("ids").mapInArrow(_bytes_seen, "byte int").distinct().collect()]
    tokens = [UNK] + sorted(_SYM[b] for b in seen)
    index = {t: i for i, t in enumerate(tokens)}
    translate = np.full(257, _END, np.int32)  # the last entry is the end mark's
    for b in seen:
        translate[b] = index[_SYM[b]]
    merges: list[tuple[int, int, int]] = []
    batch: list[tuple[int, int, int]] = []
    watched: list[tuple[int, int]] = []
    rounds, prev = 0, None
    while len(tokens) < vocab_size and (max_rounds is None or rounds < max_rounds):
        out = cur.mapInArrow(_round_fn(translate, batch, watched), ROUND).persist()
        sums = (out.where("a IS NOT NULL").groupBy("a", "b", "x").agg(F.sum("c").alias("c"))).persist()
        ranked = (sums.where(F.col("x") == _PAIR).select("a", "b", "c")
                  .orderBy(F.col("c").desc(), "a", "b").limit(top_n).collect())
        if prev is not None:  # ``out`` is materialised now; drop the round before
            prev.unpersist()
        prev, translate = out, None
        top = [(r["a"], r["b"], r["c"]) for r in ranked]
        floor = top[-1][2] if len(top) == top_n else 0
        near = _neighbours(sums, top, set(watched), floor)
        sums.unpersist()
        batch = _choose(top, near, floor, tokens, index, vocab_size - len(tokens))
        if not batch:
            break
        for a, b, new in batch:
            if new == len(tokens):
                tokens.append(tokens[a] + tokens[b])
                index[tokens[-1]] = new
        merges += batch
        gone = {(a, b) for a, b, _ in batch}
        watched = [(a, b) for a, b, _ in top if (a, b) not in gone][:watch]
        cur = out.where("a IS NULL").select("ids", "n")
        rounds += 1
        if rounds % checkpoint_every == 0:
            cur = cut_lineage(cur)
    if prev is not None:
        prev.unpersist()
    vocab = vocab_frame(spark, tokens)
    mdf = spark.createDataFrame(
        [(r, tokens[a], tokens[b], nid) for r, (a, b, nid) in enumerate(merges)],
        "rank int, left string, right string, new_id int")
    return vocab, mdf, {"rounds": rounds, "merges": len(merges), "vocab_size": len(tokens)}


def vocab_frame(spark: SparkSession, tokens: list[str]) -> DataFrame:
    rows = [(i, t, None if t == UNK else from_symbols(t), "UNKNOWN" if t == UNK else "NORMAL")
            for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "id int, token string, bytes binary, type string")


# ---------------------------------------------------------------------------
# Encode / decode
# ---------------------------------------------------------------------------
class Codec:
    """Driver-side description of a fitted tokenizer (bounded by the vocabulary
    size), shipped to executors in a broadcast variable."""

    def __init__(self, tokens: list[str], merges: list[tuple[str, str]]):
        self.tokens = tokens
        self.merges = merges
        self.index = index = {t: i for i, t in enumerate(tokens)}
        self.ranks = {(index[a], index[b]): (r, index[a + b]) for r, (a, b) in enumerate(merges)}
        self.symbol = {ch: index.get(ch, -1) for ch in _SYM}  # -1: a byte not seen in fitting

    @classmethod
    def from_frames(cls, vocab: DataFrame, merges: DataFrame) -> Codec:
        toks = [r["token"] for r in vocab.orderBy("id").select("token").collect()]
        mg = [(r["left"], r["right"]) for r in merges.orderBy("rank").select("left", "right").collect()]
        return cls(toks, mg)

    def encode_piece(self, piece: str) -> list[int]:
        if piece == UNK:
            return [self.index[UNK]]
        unk = self.index[UNK]
        ids = merge_ids([self.symbol[ch] for ch in to_symbols(piece)], self.ranks)
        return [unk if i < 0 else i for i in ids]

    def decode(self, ids) -> str:
        bs = bytearray()
        for i in ids:
            t = self.tokens[int(i)]
            if t != UNK:
                bs.extend(from_symbols(t))
        return bs.decode("utf-8", errors="replace")


AT_ONCE = 1 << 20  # pieces that a task looks up at a time
WIDTHS = (8, 16, 32)  # pieces of at most so many bytes are encoded together


def _merge_rows(ids: np.ndarray, size: np.ndarray, keys: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
    """Encodes pieces in place, a row of ``ids`` each, padded with -1: in every step each row merges the leftmost
    of its pairs of least rank.  ``keys`` are the sorted pairs (a << 32 | b) of the merges, ``made`` their results."""
    none = len(keys)

    def find(a, b):
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(keys, key), none - 1)
        return np.where(keys[at] == key, rank[at], none)

    left = np.arange(len(ids))
    cur, order, cols = ids, np.argsort(rank), np.arange(ids.shape[1])
    ranks = find(cur[:, :-1], cur[:, 1:])
    while len(left):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(at)), at]
        go = best < none
        ids[left[~go]] = cur[~go]
        left, cur, ranks, at, best = left[go], cur[go], ranks[go], at[go], best[go]
        if not len(left):
            break
        i = np.arange(len(left))
        cur[i, at] = made[order[best]]
        after = np.minimum(cols + (cols > at[:, None]), len(cols) - 1)
        cur, ranks = np.take_along_axis(cur, after, 1), np.take_along_axis(ranks, np.minimum(after[:, :-1], len(cols) - 2), 1)
        size[left] -= 1
        cur[:, -1], ranks[:, -1] = -1, none  # a row became shorter
        here, nxt, prev = cur[i, at], np.minimum(at + 1, len(cols) - 1), np.maximum(at - 1, 0)
        inner = at < len(cols) - 1
        ranks[i[inner], at[inner]] = find(here[inner], cur[i, nxt][inner])
        inner = at > 0
        ranks[i[inner], prev[inner]] = find(cur[i, prev][inner], here[inner])


def _encode_many(codec: Codec, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all ``pieces``, one after the other, and the number of ids of each."""
    pieces = pieces.cast(pa.binary())
    off = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    length, unk = np.diff(off), codec.index[UNK]
    symbol = np.array([codec.symbol[c] for c in _SYM], np.int32)
    pairs = np.array([(a << 32) | b for a, b in codec.ranks] or [-1 << 62], np.int64)  # without merges a pair that never comes
    rank, made = np.array(list(codec.ranks.values()) or [(0, 0)], np.int64).T
    order = np.argsort(pairs)
    keys, made = pairs[order], made[order].astype(np.int32)
    rank = np.argsort(np.argsort(rank[order]))  # dense, as a key may have been listed twice
    size, found, low = length.copy(), [], 1
    special = np.flatnonzero(length == len(UNK))
    special = special[[pieces[int(i)].as_py() == UNK.encode() for i in special]] if len(special) else special
    for wide in WIDTHS:
        rows = np.setdiff1d(np.flatnonzero((length >= low) & (length <= wide)), special, assume_unique=True)
        low, cols = wide + 1, np.arange(wide)
        there = cols < length[rows, None]
        ids = np.full(there.shape, -1, np.int32)
        ids[there] = symbol[data[(off[rows, None] + cols)[there]]]
        n = size[rows]
        _merge_rows(ids, n, keys, rank, made)
        size[rows] = n
        found.append((rows, ids[cols < n[:, None]]))
    others = np.concatenate([np.flatnonzero(length >= low), special])
    each = [codec.encode_piece(pieces[int(i)].as_py().decode("utf-8")) for i in others]
    size[others] = [len(e) for e in each]
    found.append((others, np.fromiter((i for e in each for i in e), np.int32)))
    out = np.empty(int(size.sum()), np.int32)
    start = np.cumsum(size) - size
    for rows, ids in found:
        n = size[rows]
        out[np.arange(len(ids)) + np.repeat(start[rows] - (np.cumsum(n) - n), n)] = ids
    return np.where(out < 0, unk, out).astype(np.int32), size


def _lookup(codec: Codec, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all ``pieces``, one after the other, and where each piece's ids end; equal pieces are encoded once."""
    known = pieces.dictionary_encode()
    ids, size = _encode_many(codec, known.dictionary)
    piece = known.indices.to_numpy()
    ends = np.cumsum(size[piece])
    start = (np.cumsum(size) - size)[piece] - (ends - size[piece])  # from a place in the output to one in ``ids``
    return ids[np.arange(ends[-1]) + np.repeat(start, size[piece])], ends


def bpe_encode(docs: DataFrame, codec: Codec, text: str = "text", out: str = "ids") -> DataFrame:
    """Ids of each text (pieces by the native pre-tokenizer, merges by rank
    in an Arrow UDF that encodes the different pieces of a batch together, long ones over a linked list with a heap)."""
    # plain lists travel in the broadcast; the codec is rebuilt per task
    bc = docs.sparkSession.sparkContext.broadcast((list(codec.tokens), list(codec.merges)))

    @F.arrow_udf("array<int>")
    def enc(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = Codec(*bc.value)
        for col in it:
            off = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))]
            pieces, parts, rows, done = col.flatten(), [], [np.zeros(1, np.int64)], 0
            for i in range(0, len(pieces), AT_ONCE):
                ids, ends = _lookup(c, pieces.slice(i, AT_ONCE))
                parts.append(ids)
                rows.append(ends + done)
                done += int(ends[-1])
            at = np.concatenate(rows)[off]
            ids = pa.array(np.concatenate([np.zeros(0, np.int32), *parts]))
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids, mask=col.is_null())

    return docs.withColumn(out, enc(split_special(F.col(text))))


def bpe_decode(df: DataFrame, codec: Codec, ids: str = "ids", out: str = "text") -> DataFrame:
    """Bytes of the tokens concatenated, decoded as UTF-8 with replacement;
    ``<unk>`` dropped.  Native: ids look their bytes up in a literal array of the
    vocabulary; ids outside it are dropped, null ids give a null text."""
    table = F.array(*[F.lit(b"" if t == UNK else from_symbols(t)).cast("string") for t in codec.tokens])
    raw = F.array_join(F.transform(F.col(ids), lambda i: F.when(i >= 0, F.get(table, i))), "")
    return df.withColumn(out, F.call_function("make_valid_utf8", raw))


# ---------------------------------------------------------------------------
# F7 for BPE tokens
# ---------------------------------------------------------------------------
def _deltas(codec: Codec, ids, reference_compat: bool) -> list[tuple[int, str | None, bool]]:
    """(step, delta, done) rows for one request's generated ids."""
    import codecs
    out: list[tuple[int, str | None, bool]] = []
    if reference_compat:  # re-decode all, emit the new suffix when the text changed
        prev = ""
        for i in range(len(ids)):
            text = codec.decode(ids[: i + 1])
            if text != prev:
                out.append((i, text[len(prev):], False))
                prev = text
        out.append((len(ids), None, True))
        return out
    dec = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for i, t in enumerate(ids):
        tok = codec.tokens[int(t)]
        piece = dec.decode(b"" if tok == UNK else from_symbols(tok))
        if piece:
            out.append((i, piece, False))
    tail = dec.decode(b"", final=True)
    out.append((len(ids), tail or None, True))
    return out


def bpe_token_deltas(generated: DataFrame, codec: Codec, key: str = "prompt_id", ids: str = "new_ids",
                     reference_compat: bool = False) -> DataFrame:
    """text deltas of generated BPE ids: ``(key, step, delta, done)``.

    Default: an incremental UTF-8 decoder holds back incomplete byte
    sequences, so no text is lost; ``reference_compat=True`` re-decodes all
    ids each step with replacement characters and emits ``text[len(prev):]``
    when the text changed, which loses text when a partial sequence first
    decodes to U+FFFD.  The final row has ``done`` true (its delta is any
    flushed tail)."""
    bc = generated.sparkSession.sparkContext.broadcast((list(codec.tokens), list(codec.merges)))
    kt = generated.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = Codec(*bc.value)
        for pdf in it:
            rows = [(k, s, d, done) for k, seq in zip(pdf[key], pdf[ids])
                    for s, d, done in _deltas(c, [int(x) for x in seq], reference_compat)]
            yield pd.DataFrame(rows, columns=[key, "step", "delta", "done"])

    return generated.select(key, ids).mapInPandas(run, f"`{key}` {kt}, step int, delta string, done boolean")

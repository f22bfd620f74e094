"""Substring deduplication by content anchors and window names of fixed depth, in place of a suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.

1. Deal out.  Every window of ``length`` bytes has one anchor: its leftmost
   GRAM-byte string with the least hash.  Consecutive windows with the same
   anchor make a phrase.  Equal windows have equal anchors at equal offsets, so
   a window repeats only in phrases with the same anchor string: anchors deal
   the windows out to tasks.  Phrases with an anchor string of their own are
   done, and equal phrases are collapsed to their first occurrence before
   windows are named (as in prefix-free parsing).
2. Name.  A task names the positions 1 and 2 mod 3 of its phrases at two fixed
   levels: triples of 8-byte letters (24 bytes) by rank, then triples of those
   names (72 bytes).  Two names of 72 bytes, with at most four letters, cover a window.
3. Group.  Equal windows have equal keys made of these names.  Three passes, each
   over two of the classes mod 3 with a key that both have, compare every pair of
   classes; in each, all but the first window of a key in the corpus go.

No suffix order is made: there is no recursion to full depth, no merge and no
comparison of neighbours.  Sorting every byte's suffix across the cluster would
shuffle some 20 bytes per byte of text (an estimate, not measured); dealing out by anchors moves narrow rows for 2 in 77 positions,
and bytes only for phrases that share an anchor and differ.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from corpusloom.llm.common import blocks, map_batches, utf8
from corpusloom.llm.words import BASES, Polynomials, mix
from corpusloom.llm.tables import stored

LENGTH = 100
GRAM = 24
PARSE_BYTES, SORT_BYTES = 1 << 20, 1 << 20
_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def parse(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """The phrases of texts laid end to end: (text, start in text, windows, anchor hash, phrase hash)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none
    h = mix(data.astype(_U) + _U(1))
    letters, total = h, None
    by = {1: h}
    size = 1
    while size < 16:
        h = h[:-size] * _A ** _U(size) + h[size:] * _B
        h = h ^ (h >> _U(29))
        size *= 2
        by[size] = h
    m = n - GRAM + 1
    gram = mix(by[16][:m] * _A + by[8][16:16 + m] * _B)
    del by
    low = (gram >> _U(32) << _U(32)) | np.arange(m, dtype=_U)
    span, have = LENGTH - GRAM + 1, 1
    while have * 2 <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:n - LENGTH + 1], low[span - have:][:n - LENGTH + 1])
    anchor = (low & _U(0xFFFFFFFF)).astype(np.int64)
    fits = np.ones(len(anchor), bool)
    for e in off[1:-1]:  # windows that would cross into the next text
        fits[max(0, e - LENGTH + 1):e] = False
    v = np.flatnonzero(fits)
    if not len(v):
        return none, none, none, none, none
    a = anchor[v]
    cut = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (v[1:] != v[:-1] + 1)) + 1])
    start, count = v[cut], np.diff(np.concatenate([cut, [len(v)]]))
    up, down = Polynomials().table(BASES[0], n)
    total = np.concatenate([np.zeros(1, _U), np.cumsum(letters * up[:n])])
    stop = start + count - 1 + LENGTH
    phrase = mix((total[stop] - total[start]) * down[start] + count.astype(_U))
    text = np.searchsorted(off, start, side="right") - 1
    return text, start - off[text], count, gram[a[cut]].view(np.int64), phrase.view(np.int64)


def _phrases(docs: DataFrame) -> DataFrame:
    id_type = dict(docs.dtypes)["id"]

    def run(b: pa.RecordBatch) -> dict:
        data, off = utf8(b.column(1))
        out = [[], [], [], [], []]
        for i, j in blocks(off, PARSE_BYTES):
            found = parse(data[off[i]:off[j]], off[i:j + 1] - off[i])
            for k, x in enumerate(found):
                out[k].append(x + i if k == 0 else x)
        text, start, count, anchor, phrase = (np.concatenate(x + [np.zeros(0, np.int64)]) for x in out)
        text = pa.array(text, pa.int64())
        return {"id": b.column(0).take(text), "th": b.column(2).take(text), "at": start * 128 + count, "anchor": anchor, "phrase": phrase}

    return map_batches(docs, run, f"id {id_type}, th long, at long, anchor long, phrase long")


def _phrase_bytes(rows: DataFrame) -> DataFrame:
    """(id, text, wanted array<struct<at,anchor>>, th) to (anchor, id, th, at, bytes)."""
    id_type = dict(rows.dtypes)["id"]

    def run(b: pa.RecordBatch) -> dict:
        which, anchor, at, out = [], [], [], []
        for i, (t, wanted) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
            raw = t.encode("utf-8")
            for w in wanted:
                s, c = divmod(w["at"], 128)
                which.append(i)
                anchor.append(w["anchor"])
                at.append(w["at"])
                out.append(raw[s:s + c - 1 + LENGTH])
        which = pa.array(which, pa.int64())
        return {"anchor": anchor, "id": b.column(0).take(which), "th": b.column(3).take(which), "at": at, "bytes": out}

    return map_batches(rows, run, f"anchor long, id {id_type}, th long, at long, bytes binary")


def _ranks(*cols: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by their columns."""
    bits = [max(1, int(c.max()).bit_length()) if len(c) else 1 for c in cols]
    if sum(bits) <= 64:
        key = np.zeros(len(cols[0]), _U)
        for c, k in zip(cols, bits):
            key = (key << _U(k if k < 64 else 0)) | c.astype(_U)
        return np.unique(key, return_inverse=True)[1]
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(order), bool)
    for c in cols:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _later(rank: np.ndarray) -> np.ndarray:
    """Which entries equal an entry before them."""
    again = np.ones(len(rank), bool)
    again[np.unique(rank, return_index=True)[1]] = False
    return again


def repeated_windows(texts: list[bytes], windows: np.ndarray) -> np.ndarray:
    """For the windows of all texts, in order, whether an equal window stands before (names at 1, 2 mod 3)."""
    size = np.array([len(t) for t in texts], np.int64)
    t = np.frombuffer(b"".join(texts) + bytes(160), np.uint8)
    n = len(t) - 96
    u = t.astype(_U)
    pair = (u[:-1] << _U(8)) | u[1:]
    four = (pair[:-2] << _U(16)) | pair[2:]
    eight = (four[:-4] << _U(32)) | four[4:]
    sample = np.flatnonzero(np.arange(n) % 3)
    name = np.zeros(len(t), np.int64)
    name[sample] = _ranks(eight[sample], eight[sample + 8], eight[sample + 16])  # triples of letters: 24 bytes
    name72 = np.zeros(len(t), np.int64)
    name72[sample] = _ranks(name[sample], name[sample + 24], name[sample + 48])  # triples of names: 72 bytes
    first = np.cumsum(size) - size
    p = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    gone, c = np.zeros(len(p), bool), p % 3
    for keep, key in (
        (c != 0, lambda q: (name72[q], name72[q + 27], t[q + 99])),                      # both sampled
        (c != 2, lambda q: (t[q], name72[q + 1], name72[q + 28])),                       # 0 and 1 mod 3
        (c != 1, lambda q: (_ranks(t[q], t[q + 1], t[q + 98], t[q + 99]), _ranks(name72[q + 2], name72[q + 26]))),  # 0 and 2 mod 3
    ):
        if keep.any():
            gone[keep] |= _later(_ranks(*key(p[keep])))
    return gone


def _sorted_out(rows: DataFrame) -> DataFrame:
    """The runs (id, begin, stop) of bytes whose windows stand earlier among the given phrases, dealt out by anchor."""
    id_type = dict(rows.dtypes)["id"]
    schema = to_arrow_schema(_parse_datatype_string(f"id {id_type}, th long, begin long, stop long"))

    def solve(table: pa.Table):
        ids = table.column("id").to_pylist()
        at = table.column("at").to_numpy()
        th = table.column("th").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, th[i], at[i]))
        texts = table.column("bytes").to_pylist()
        at = at[order]
        start, count = at // 128, at % 128
        gone = repeated_windows([texts[i] for i in order], count)
        owner = np.repeat(np.arange(len(order)), count)
        place = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(gone))
        k = np.flatnonzero(gone)
        if not len(k):
            return None
        cut = np.concatenate([[0], np.flatnonzero((np.diff(k) > 1) | (np.diff(owner[k]) > 0)) + 1])
        last = np.concatenate([cut[1:] - 1, [len(k) - 1]])
        who = [order[i] for i in owner[k[cut]]]
        return pa.RecordBatch.from_arrays([pa.array([ids[i] for i in who], schema.field("id").type), pa.array([th[i] for i in who], pa.int64()), pa.array(place[k[cut]]),
                                           pa.array(place[k[last]] + LENGTH)], schema=schema)

    def run(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows == 0:
                continue
            held.append(b)
            size += b.nbytes
            if size < SORT_BYTES:
                continue
            t = pa.Table.from_batches(held)
            a = t.column("anchor").to_numpy()
            whole = int(np.searchsorted(a, a[-1], side="left"))  # the last anchor may go on
            if whole:
                out = solve(t.slice(0, whole))
                if out is not None:
                    yield out
                held = t.slice(whole).to_batches()
                size = sum(x.nbytes for x in held) if len(held) else 0
        if held:
            out = solve(pa.Table.from_batches(held))
            if out is not None:
                yield out

    dealt = rows.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, f"id {id_type}, th long, begin long, stop long")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, begin, stop): runs of bytes to remove, by id and hash of the text; they may overlap."""
    base = _base(docs, id_col, text_col)
    by_anchor, by_phrase = W.partitionBy("anchor"), W.partitionBy("anchor", "phrase")
    place = F.struct("id", "th", "at")
    shared = stored(_phrases(base).withColumn("low", F.min("phrase").over(by_anchor)).withColumn("high", F.max("phrase").over(by_anchor))
                    .withColumn("first", F.min(place).over(by_phrase))
                    .withColumn("is_first", place.eqNullSafe(F.col("first")))
                    .where("low != high or not is_first")
                    .select("id", "th", "at", "anchor", "is_first", (F.col("low") != F.col("high")).alias("mixed")))
    start = F.floor(F.col("at") / 128).cast("long")
    copies = shared.where("not is_first").select("id", "th", start.alias("begin"), (start + F.col("at") % 128 - 1 + LENGTH).alias("stop"))
    wanted = (shared.where("is_first and mixed").distinct().groupBy("id", "th").agg(F.collect_list(F.struct("at", "anchor")).alias("wanted"))
              .select(F.col("id").alias("__id"), F.col("th").alias("__th"), "wanted"))
    same = base["id"].eqNullSafe(wanted["__id"]) & (base["th"] == wanted["__th"])
    rows = base.join(wanted, same).select("id", "text", "wanted", "th")
    return stored(copies.unionByName(_sorted_out(_phrase_bytes(rows))))


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_bytes, n_removed, n_spans, kept).

    ``kept`` (binary) is what remains of the UTF-8 bytes; a removed run may begin or end inside a
    character.  Strings are judged on the input.  Null texts are empty; texts shorter than a window
    lose nothing.  Earlier means a smaller id, or the same id and an earlier start; a null id comes
    first.  Rows with one id and one text count as one document; rows with one id (or none) and different
    texts are different documents, in the order of a hash of their texts.  A text, and the distinct phrases of
    one anchor, have to fit in a task.
    """
    runs = repeated_runs(docs, id_col, text_col)
    per_doc = runs.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set(F.struct("begin", "stop")).alias("runs"))
    base = _base(docs, id_col, text_col)
    id_type = dict(base.dtypes)["id"]

    def run(b: pa.RecordBatch) -> dict:
        n, removed, spans, kept = [], [], [], []
        for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            raw = t.encode("utf-8")
            parts, pos, cut, k = [], 0, 0, 0
            for r in sorted((r["begin"], r["stop"]) for r in found or []):
                if r[1] <= pos and k:
                    continue
                if k == 0 or r[0] > pos:
                    parts.append(raw[pos:r[0]])
                    k += 1
                    cut += r[1] - r[0]
                else:
                    cut += r[1] - pos
                pos = r[1]
            parts.append(raw[pos:])
            n.append(len(raw))
            removed.append(cut)
            spans.append(k)
            kept.append(b"".join(parts))
        return {id_col: b.column(0), "n_bytes": n, "n_removed": removed, "n_spans": spans, "kept": kept}

    same = base["id"].eqNullSafe(per_doc["__id"]) & (base["th"] == per_doc["__th"])
    joined = base.join(per_doc, same, "left").select("id", "text", "runs")
    return map_batches(joined, run, f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()

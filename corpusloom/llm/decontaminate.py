"""Benchmark decontamination by a prefix-filtered set join.

An item's windows of ``n`` consecutive words must be contained whole in a
document, so the necessary prefix of a window, its words ordered by rarity in
the corpus, is its rarest word alone.  Documents are joined to the windows on
that word; the position of the word in the window bounds where the window must
start, the lengths bound whether it fits, and the words there are compared.

Document frequencies cover every document; only words of the benchmark are
counted.  The windows reach the tasks in blocks of at most ``BLOCK_WINDOWS``,
each a broadcast of bounded size; further blocks pass over the same documents
in the same job, so a benchmark of any size is handled.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_batches

WINDOW = 10
BLOCK_WINDOWS = 400_000  # windows per broadcast: some 60 MB as Python objects
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # lower-cased words; any byte of a non-ASCII character counts


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "replace").lower()) if text else []


def item_windows(ws: list[bytes], n: int = WINDOW) -> set[tuple[bytes, ...]]:
    """All runs of n words; an item with fewer words, but not none, is one window."""
    if not ws:
        return set()
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))}


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, n: int, limit: int):
    """Blocks {window: [item ids]}: items stream to the driver, one partition at a time."""
    block: dict[tuple[bytes, ...], list] = {}
    for r in benchmark.select(id_col, text_col).toLocalIterator():
        for w in item_windows(words(r[1]), n):
            block.setdefault(w, []).append(r[0])
        if len(block) >= limit:
            yield block
            block = {}
    if block:
        yield block


def document_frequency(docs: DataFrame, vocabulary: set[bytes], text_col: str) -> dict[bytes, int]:
    """Documents that hold each word of ``vocabulary``, counted over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(b: pa.RecordBatch) -> dict:
        from collections import Counter
        c = Counter()
        for t in b.column(0).to_pylist():
            c.update(shared.value.intersection(words(t)))
        return {"w": list(c), "n": list(c.values())}

    rows = map_batches(docs.select(text_col), count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return {bytes(r["w"]): r["n"] for r in rows.toLocalIterator()}


def prefix_index(block: dict[tuple[bytes, ...], list], df: dict[bytes, int]):
    """{rarest word: {(its position, length): {window: items}}}."""
    index: dict[bytes, dict] = {}
    for w, items in block.items():
        at = min(range(len(w)), key=lambda i: (df.get(w[i], 0), w[i], i))
        index.setdefault(w[at], {}).setdefault((at, len(w)), {})[w] = items
    return index


def find_hits(ws: list[bytes], index: dict, hit: np.ndarray, items: set) -> None:
    """Marks the words inside occurrences of the index's windows and adds their items."""
    if index.keys().isdisjoint(ws):
        return
    n = len(ws)
    for i, w in enumerate(ws):
        places = index.get(w)
        if places is None:
            continue
        for (at, size), windows in places.items():
            s = i - at
            if s >= 0 and s + size <= n:  # positional and length bounds
                found = windows.get(tuple(ws[s:s + size]))
                if found is not None:
                    hit[s:s + size] = True
                    items.update(found)


def shared_indexes(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str,
                   window: int, block_windows: int) -> list:
    """The broadcast prefix index of each block of windows."""
    out = []
    for b in benchmark_blocks(benchmark, item_id, item_text, window, block_windows):
        df = document_frequency(docs, set(chain.from_iterable(b)), text_col)
        out.append(docs.sparkSession.sparkContext.broadcast(prefix_index(b, df)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: (id, n_words, hit_words, items).

    ``hit_words``: positions of words inside occurrences of benchmark windows, as [from, to) runs;
    ``items``: the items with such windows, as sorted strings.  Null texts have no words and items
    without words have no windows; an item without an id marks words, but is in no list.  Repeated documents or
    items repeat or merge their results.
    """
    id_type = dict(docs.dtypes)[id_col]
    indexes = shared_indexes(docs, benchmark, text_col, item_id, item_text, window, block_windows)

    def run(b: pa.RecordBatch) -> dict:
        n, runs, found = [], [], []
        for t in b.column(1).to_pylist():
            ws, items = words(t), set()
            hit = np.zeros(len(ws) + 2, np.int8)
            for ix in indexes:
                find_hits(ws, ix.value, hit[1:-1].view(bool), items)
            edge = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
            n.append(len(ws))
            runs.append([{"from": int(x), "to": int(y)} for x, y in edge])
            found.append(sorted({str(i) for i in items if i is not None}))
        return {id_col: b.column(0), "n_words": n, "hit_words": runs, "items": found}

    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {id_type}, n_words long, hit_words array<struct<from:long,to:long>>, items array<string>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents without any benchmark window, with all their columns; no shuffle."""
    indexes = shared_indexes(docs, benchmark, text_col, item_id, item_text, window, block_windows)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            keep = []
            for t in b.column(at).to_pylist():
                ws, items = words(t), set()
                hit = np.zeros(len(ws), bool)
                for ix in indexes:
                    find_hits(ws, ix.value, hit, items)
                keep.append(not items)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""Token counts by offset-mapped attribution.

A document is encoded once, whole.  The tokens' byte spans, mapped to the text,
are joined as intervals with the spans of its sections (both sorted, so one
binary search per token), and a token that crosses a boundary goes to a section
by an explicit rule:

  start     the section that holds its first byte
  majority  the section that holds most of its bytes, the earlier one in a tie
  split     each section gets the share of the bytes that it holds

The vocabulary (about 1 MB) is read on the driver and broadcast; executors need
no file.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame

from corpusloom.llm.common import Shared, map_batches

RULES = ("start", "majority", "split")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: goes with the vocabulary


class Encoder:
    """A byte-level BPE from a file of base64 tokens and ranks; its codec is made once per worker."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern

    def _codec(self):
        if "_made" not in self.__dict__:
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            size = np.zeros(max(ranks.values()) + 1, np.int64)
            for t, i in ranks.items():
                size[i] = len(t)
            self._made = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}), size
        return self._made

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    def token_ends(self, text: str) -> np.ndarray:
        """The byte offset at which each token ends."""
        codec, size = self._codec()
        return np.cumsum(size[np.array(codec.encode_ordinary(text), np.int64)])


def load_encoder(path: str) -> Encoder:
    with open(path, "rb") as f:  # a vocabulary of the installed package, on the driver
        return Encoder(f.read())


def line_bounds(raw: np.ndarray) -> np.ndarray:
    """Byte bounds of the lines, each with its newline: 0, ends of lines."""
    cut = np.flatnonzero(raw == 10) + 1
    return np.unique(np.concatenate([[0], cut, [len(raw)]]))


def attribute(ends: np.ndarray, begin: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section [begin, stop) (sorted, disjoint; gaps allowed), and how many of them cross a bound.

    Tokens that touch no section belong to none.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    count, crossing = np.zeros(len(begin)), np.zeros(len(begin), np.int64)
    if not len(ends) or not len(begin):
        return count, crossing
    first = np.searchsorted(stop, starts, side="right")
    last = np.searchsorted(begin, ends, side="left") - 1
    inside = (first == last) & (first < len(begin))
    safe = np.minimum(first, len(begin) - 1)
    whole = inside & (begin[safe] <= starts) & (ends <= stop[safe])
    count += np.bincount(first[whole], minlength=len(begin))
    for t in np.flatnonzero(~whole & (first <= last)):  # those that cross a bound
        s = np.arange(first[t], last[t] + 1)
        part = np.minimum(ends[t], stop[s]) - np.maximum(starts[t], begin[s])
        if rule == "split":
            count[s] += part / (ends[t] - starts[t])
            crossing[s] += 1
            continue
        if rule == "start" and begin[s[0]] > starts[t]:
            continue  # its first byte is in no section
        to = s[0] if rule == "start" else s[int(part.argmax())]
        count[to] += 1
        crossing[to] += 1
    return count, crossing


def _char_at(raw: np.ndarray) -> np.ndarray | None:
    """Code points before each byte, or None where bytes are code points."""
    lead = (raw & 0xC0) != 0x80
    return None if lead.all() else np.concatenate([[0], np.cumsum(lead)])


def token_counts(docs: DataFrame, encoder: Encoder, id_col: str = "doc_id", text_col: str = "text",
                 sections_col: str | None = None, rule: str = "majority") -> DataFrame:
    """One row per section: (id, section, name, start, end, tokens, crossing, doc_tokens).

    Sections are the text's lines (with their newline) by default, or a column
    of array<struct<name:string,start:long,end:long>> in code points, sorted and
    disjoint.  A document without sections (null or empty text, empty or null
    array) has one row with a null section and its token count.  Repeated rows
    are counted each.  ``tokens`` is whole but for the rule ``split``.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = Shared(docs.sparkSession, encoder)
    id_type = dict(docs.dtypes)[id_col]
    cols = [id_col, text_col] + ([sections_col] if sections_col else [])

    def run(b: pa.RecordBatch) -> dict:
        enc = shared.value
        texts = b.column(1).fill_null("").to_pylist()
        given = b.column(2).to_pylist() if sections_col else [None] * len(texts)
        at, out = [], {k: [] for k in ("section", "name", "start", "end", "tokens", "crossing", "doc_tokens")}
        for i, text in enumerate(texts):
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            ends, chars = enc.token_ends(text), _char_at(raw)
            if sections_col:
                spans = given[i] or []
                begin = np.array([s["start"] for s in spans], np.int64)
                stop = np.array([s["end"] for s in spans], np.int64)
                if chars is not None:  # code points to bytes
                    first = np.searchsorted(chars, np.arange(len(text) + 1), side="right") - 1
                    first[-1] = len(raw)
                    begin, stop = first[begin], first[stop]
                names = [s["name"] for s in spans]
            else:
                bounds = line_bounds(raw) if len(raw) else np.zeros(1, np.int64)
                begin, stop = bounds[:-1], bounds[1:]
                names = [None] * len(begin)
            n = len(begin)
            if n == 0:
                at.append(i)
                for k, v in zip(out, (None, None, None, None, float(len(ends)), 0, len(ends))):
                    out[k].append(v)
                continue
            count, crossing = attribute(ends, begin, stop, rule)
            at += [i] * n
            out["section"] += range(n)
            out["name"] += names
            out["start"] += (begin if chars is None else chars[begin]).tolist()
            out["end"] += (stop if chars is None else chars[stop]).tolist()
            out["tokens"] += count.tolist()
            out["crossing"] += crossing.tolist()
            out["doc_tokens"] += [len(ends)] * n
        out[id_col] = b.column(0).take(pa.array(at, pa.int64()))
        return out

    return map_batches(docs.select(*cols), run, f"`{id_col}` {id_type}, section long, name string, start long, end long, "
                                                "tokens double, crossing long, doc_tokens long")


def vocabulary_path(spark_context: SparkContext, name: str = "byte_bpe_50k.tiktoken") -> str:
    """The file in the folder that ``spark.corpusloom.tokenizers`` names (default /opt/tokenizers)."""
    return spark_context.getConf().get("spark.corpusloom.tokenizers", "/opt/tokenizers").rstrip("/") + "/" + name

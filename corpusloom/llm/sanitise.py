"""Information-theoretic sanitisation of personal data.

Base entities (email, ip, card, phone) are found by pattern.  Around each
mention, the words within ``REACH`` characters are its terms.  Over the whole
corpus, document frequencies say how strongly a term t reveals an entity e:

    disclosure(t, e) = PMI(t; e) / IC(e)
                     = log(N * df(e, t) / (df(e) * (df(t) + SMOOTH))) / log(N / df(e))

which without smoothing is 1 where t occurs only beside e.  Half a document is
added to every term's frequency, so that a term seen once says a little less
than its count.  A term whose disclosure of any entity reaches ``GENERALISE`` is
replaced by a general word wherever it stands in any text; from ``REMOVE`` on it
is removed.

No text is shuffled: texts are read three times (mentions; term frequencies;
occurrences of the disclosing terms), and only mentions, 64-bit term hashes with
counts, and spans move.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_batches
from corpusloom.llm.tables import stored

REACH = 120
GENERALISE, REMOVE = 0.8, 0.95
SMOOTH = 0.5
FILTER_BITS = 23  # a filter of 1 MB, whatever the number of disclosing terms
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match never starts inside digits: the look-behind only saves retries
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ so that long runs are read once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > end and text[s - 1] in LOCAL_PART:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            end = m.end()
            out.append((s, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _hash(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.int64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False).view(np.int64)


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else f"{kind}:{re.sub('[^0-9]', '', value)}"


def terms_near(text: str, start: int, end: int, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Whole words within REACH characters of a mention that overlap no base span."""
    out = []
    for lo, hi in ((max(0, start - REACH), start), (end, min(len(text), end + REACH))):
        for m in TERM.finditer(text, lo, hi):
            a, b = m.span()
            if (a == lo and a > 0 and text[a - 1].isalpha()) or (b == hi and b < len(text) and text[b].isalpha()):
                continue
            if not any(x < b and a < y for _, x, y in taken if x < hi and y > lo):
                out.append((a, b))
    return out


MENTION = "array<struct<entity:long,term:long>>"


def base_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, row_key, spans, mentions); equal rows have equal keys."""
    id_type = dict(docs.dtypes)[id_col]
    keyed = docs.select(id_col, F.xxhash64(F.col(id_col).cast("string"), text_col).alias("row_key"), text_col)

    def run(b: pa.RecordBatch) -> dict:
        spans, mentions = [], []
        for t in b.column(2).fill_null("").to_pylist():
            base = base_spans(t)
            ents, words = [], []
            near = sorted(base, key=lambda x: x[1]) if len(base) < 64 else base
            for kind, a, z in base:
                ws = terms_near(t, a, z, near)
                ents += [_entity(kind, t[a:z])] * len(ws)
                words += [t[x:y].lower() for x, y in ws]
            spans.append([{"kind": k, "start": a, "end": z} for k, a, z in base])
            found = set(zip(_hash(ents).tolist(), _hash(words).tolist()))
            mentions.append([{"entity": e, "term": w} for e, w in found])
        return {id_col: b.column(0), "row_key": b.column(1), "spans": spans, "mentions": mentions}

    return map_batches(keyed, run, f"`{id_col}` {id_type}, row_key long, spans array<struct<kind:string,start:int,end:int>>, mentions {MENTION}")


def term_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that hold each term, (term, df), counted over all whole texts."""

    def run(b: pa.RecordBatch) -> dict:
        c: Counter = Counter()
        for t in b.column(0).fill_null("").to_pylist():
            c.update({w.lower() for w in set(TERM.findall(t))})
        return {"term": _hash(list(c)), "df": list(c.values())}

    return map_batches(docs.select(text_col), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach the threshold."""
    n = found.count()  # all four counts are of rows: repeated rows count each time
    pairs = found.select(F.inline("mentions")).groupBy("entity", "term").agg(F.count("*").alias("df_et"))
    once = F.array_distinct(F.transform("mentions", lambda m: m["entity"]))
    entities = found.select(F.explode(once).alias("entity")).groupBy("entity").agg(F.count("*").alias("df_e"))
    pairs = pairs.join(entities, "entity").where(F.col("df_e") < n)
    pmi = F.log(F.lit(float(n)) * F.col("df_et") / (F.col("df_e") * (F.greatest("df", "df_et") + F.lit(SMOOTH))))
    return (pairs.join(term_frequencies(docs, text_col), "term")
            .withColumn("disclosure", pmi / F.log(F.lit(float(n)) / F.col("df_e")))
            .where(F.col("disclosure") >= generalise).select("entity", "term", "disclosure"))


def _filter(terms: DataFrame) -> np.ndarray:
    """One bit per value of the lowest FILTER_BITS bits of a term: set where a term of ``terms`` has it."""
    slot = F.col("term").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (terms.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(term & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).collect())  # at most 2^17 rows
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[[r["w"] for r in words]] = [r["b"] for r in words]
    return out


def occurrences(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, start, end, action) wherever one of ``terms`` (term, action) stands in a text, outside base spans.

    A filter of fixed size keeps most other words from moving; the join decides.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_filter(terms))
    keyed = docs.select(F.xxhash64(F.col(id_col).cast("string"), text_col).alias("row_key"), text_col)

    def run(b: pa.RecordBatch) -> dict:
        keys, texts = b.column(0).to_pylist(), b.column(1).fill_null("").to_pylist()
        each = [set(TERM.findall(t)) for t in texts]
        words = list(set().union(*each))
        h = _hash([w.lower() for w in words])
        slot = h & ((1 << FILTER_BITS) - 1)
        hit = np.flatnonzero((bits.value[slot >> 6] >> (slot & 63)) & 1)
        wanted = {words[i]: int(h[i]) for i in hit}
        out = {"row_key": [], "term": [], "start": [], "end": []}
        for key, t, have in zip(keys, texts, each):
            if wanted.keys().isdisjoint(have):
                continue
            base, at = sorted((a, z) for _, a, z in base_spans(t)), 0
            reach = np.maximum.accumulate([z for _, z in base]).tolist() if base else []  # the ends of spans so far
            for m in TERM.finditer(t):
                x, y = m.span()
                while at < len(base) and base[at][0] < y:
                    at += 1
                if m[0] in wanted and not (at and reach[at - 1] > x):
                    for k, v in zip(out, (key, wanted[m[0]], x, y)):
                        out[k].append(v)
        return out

    return map_batches(keyed, run, "row_key long, term long, start int, end int").join(terms, "term").select("row_key", "start", "end", "action")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """One row per document: (id, row_key, spans), spans of kind, start, end and action.

    Base kinds come first in the order of KINDS, then ``term`` spans; each kind
    by start.  Null and empty texts have no spans.  Repeated rows have the same
    spans.  A corpus of one document, or an entity in every document, discloses
    nothing.  Other columns are not read.
    """
    found = stored(base_mentions(docs, id_col, text_col))
    action = F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise")
    risky = stored(disclosing_terms(docs, found, text_col, **thresholds).groupBy("term").agg(action.alias("action")))
    extra = (occurrences(docs, risky, id_col, text_col).distinct()
             .groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("terms")))
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("remove").alias("action")))
    term = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["action"].alias("action")))
    return found.join(extra, "row_key", "left").select(
        id_col, "row_key", F.when(F.col("terms").isNull(), base).otherwise(F.concat(base, term)).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with base entities replaced by their kind, terms generalised to <term> or removed."""
    spans = personal_data(docs, id_col, text_col).select("row_key", "spans").dropDuplicates(["row_key"])
    keyed = docs.select(id_col, F.xxhash64(F.col(id_col).cast("string"), text_col).alias("row_key"), text_col)
    id_type = dict(docs.dtypes)[id_col]

    def run(b: pa.RecordBatch) -> dict:
        out = []
        for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            pos, parts = 0, []
            for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                if s["start"] < pos:  # inside a span of another kind: that one covers it
                    pos = max(pos, s["end"])
                    continue
                parts.append(t[pos:s["start"]])
                parts.append("" if s["kind"] == "term" and s["action"] == "remove" else f"<{s['kind']}>")
                pos = s["end"]
            out.append(None if t is None else "".join(parts) + t[pos:])
        return {id_col: b.column(0), text_col: out}

    return map_batches(keyed.join(spans, "row_key").select(id_col, text_col, "spans"), run, f"`{id_col}` {id_type}, `{text_col}` string")

"""Phrase collocation mining by Rabin-Karp fingerprints.

Words get prefix-polynomial hashes from their bytes, n-grams from the prefix polynomial over the words of
their piece, so that every n-gram of a block costs a subtraction and a multiplication.  Fingerprints hold the
language and the number of words.

1. Words and pairs: each task sums the counts of its fingerprints, a shuffle sums the tasks'.  Those with
   ``min_count`` occurrences set a bit in a bitmap of fixed size (``BITMAP_BITS``), which is broadcast.  It only saves
   shuffling: a fingerprint that it lets through by chance is counted and dropped later.
2. All n-grams whose words and pairs may be frequent: a shuffle sums their counts and keeps one occurrence
   pointer (hash of the row, byte of the first word, number of words) and the least and greatest of a second,
   independent fingerprint.
3. The pointers of frequent fingerprints are joined with the rows they point to, each row's once, and only these phrases
   become text, whose fingerprints must be the pointer's.
4. A fingerprint with two different second fingerprints stands for different phrases: these are counted by
   their text instead.  (Two phrases equal in both, 128 bits, would be taken as one.)

Scores and the rest are joins and aggregates on the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import blocks, utf8
from corpusloom.llm.tables import stored
from corpusloom.llm.words import BASES, LOWER, Polynomials, byte_table, joined, mix, spans

BITMAP_BITS = 27         # 16 MB
BLOCK = (1 << 19) - 1    # bytes of text that are hashed at a time, but whole texts
FLUSH_WORDS = 1 << 19    # words whose n-grams are summed at a time, but whole blocks
SHARES = 64              # of a language's phrases, ranked apart first
WORD_BITS = 4            # of a pointer, for its number of words
STOPS = byte_table(b".,;:!?\n\x0b\x0c\r")
BLANKS = byte_table(b" \t")
_U = np.uint64


class Words:
    """The words of some texts: spans, hashes, pieces and texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, salts: np.ndarray, bits: int, twice: bool, poly: Polynomials):
        data = LOWER[data]
        self.s, self.e, self.doc = spans(data, off, BLANKS | STOPS)
        stop = np.concatenate([[0], np.cumsum(STOPS[data])])
        self.piece = stop[self.s] + self.doc if len(self.s) else self.s  # grows with each stop and each text
        self.data, self.off, self.salts, self.bits, self.poly = data, off, salts, bits, poly
        self.hash = [poly.words(data, self.s, self.e, b) for b in BASES[:1 + twice]]

    def ngrams(self, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The first words of the n-grams within a piece, and their fingerprints; n = 0: one empty n-gram per word."""
        at = np.arange(len(self.s) - max(n, 1) + 1)
        if n > 1:
            at = at[self.piece[at] == self.piece[at + n - 1]]
        out = []
        for base, h in zip(BASES, self.hash):
            code = self.poly.sums(h, at, at + n, base) + self.salts[self.doc[at]] * _U(base) + _U(n)
            out.append(mix(code) & _U((1 << self.bits) - 1) if base == BASES[0] else mix(code))
        return at, out

    def pointer(self, at: np.ndarray, n: int) -> np.ndarray:
        return ((self.s[at] - self.off[self.doc[at]]) << WORD_BITS) | n

    def text(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases of n words from ``at`` on, joined by one space."""
        w = (at[:, None] + np.arange(n)).ravel()
        raw, ends = joined(self.data, self.s[w], self.e[w], np.arange(len(w)) % max(n, 1) == 0)
        cut = np.concatenate([[0], ends[n - 1::n]]) if n else np.zeros(len(at) + 1)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())).cast(pa.string())


def _salt(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode("utf-8"), digest_size=8).digest(), "little")


def _texts(batch: pa.RecordBatch, bits: int, twice: bool, poly: Polynomials) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of a batch (row, lang, text) and their words."""
    data, off = utf8(batch.column(2))
    langs = batch.column(1).to_pylist()
    for i, j in blocks(off, BLOCK):
        salts = np.array([_salt(x) for x in langs[i:j]], _U)
        yield i, j, Words(data[off[i]:off[j]], off[i:j + 1] - off[i], salts, bits, twice, poly)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, where each key begins in it, and how often it occurs."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1]) if len(k) else np.zeros(0, np.int64)
    return order, cut, np.diff(np.concatenate([cut, [len(k)]]))


def _rows(table: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col), F.lit(""))
    return table.select(F.xxhash64(lang, text).alias("row"), lang.alias("lang"), text.alias("text"))


def _counts(rows: DataFrame, orders: tuple[int, ...], bits: int) -> DataFrame:
    """(fp, c): fingerprints of the n-grams of the given orders and their counts, summed per task."""
    def run(batches):
        kept, words, poly = [], 0, Polynomials()

        def flush():
            keys = np.concatenate(kept)
            order, cut, c = _sorted(keys)
            return pa.RecordBatch.from_arrays([pa.array(keys[order[cut]].view(np.int64)), pa.array(c.astype(np.int64))], names=["fp", "c"])

        for b in batches:
            for _, _, w in _texts(b, bits, False, poly):
                kept += [w.ngrams(n)[1][0] for n in orders]
                words += len(w.s)
                if words >= FLUSH_WORDS:
                    yield flush()
                    kept, words = [], 0
        if kept:
            yield flush()

    return rows.mapInArrow(run, "fp long, c long").groupBy("fp").agg(F.sum("c").alias("c"))


def bitmap(fps: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for each fingerprint, by its low bits: words of 64 bits, at most 2^(bits - 6) rows, made in tasks."""
    word = F.shiftright("fp", 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    set_ = (fps.groupBy(word.cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(fp & 63 as int))")).alias("b")).toArrow())
    out = np.zeros(1 << (bits - 6), _U)
    out[set_.column("w").to_numpy()] = set_.column("b").to_numpy().view(_U)
    return out


def _maybe(have: np.ndarray, fp: np.ndarray) -> np.ndarray:
    word = (fp >> _U(6)) & _U(len(have) - 1)
    return (have[word.astype(np.int64)] >> (fp & _U(63))) & _U(1) == 1


def _candidates(w: Words, orders, have: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """The n-grams whose words (n = 1) or pairs (n > 1) may all be frequent; n = 0: one at the first word of each text."""
    pairs = np.zeros(len(w.s) + 1, bool)
    at, fps = w.ngrams(2)
    pairs[at] = _maybe(have, fps[0])
    inside = np.concatenate([[0], np.cumsum(pairs)])
    for n in orders:
        at, fps = w.ngrams(n)
        if n == 1:
            ok = _maybe(have, fps[0])
        elif n > 1:
            ok = inside[at + n - 1] - inside[at] == n - 1
        else:
            ok = np.concatenate([[True], w.doc[1:] != w.doc[:-1]])[:len(at)]
        yield n, at[ok], [x[ok] for x in fps]


FOUND = "fp long, c long, chk_min long, chk_max long, row long, ptr long"


def _pointers(rows: DataFrame, orders: tuple[int, ...], have, bits: int) -> DataFrame:
    """FOUND of the candidates: counts, an occurrence, and the bounds of the second fingerprint, summed per task and then over all."""
    def run(batches):
        cols, words, poly = [], 0, Polynomials()

        def batch(*cols):
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["fp", "c", "chk_min", "chk_max", "row", "ptr"])

        def flush():
            fp, chk, row, ptr = (np.concatenate(c) for c in zip(*cols))
            order, cut, c = _sorted(fp)
            chk, one = chk[order], order[cut]
            low, high = (np.minimum.reduceat(chk, cut), np.maximum.reduceat(chk, cut)) if len(cut) else (chk, chk)
            return batch(fp[one].view(np.int64), c, low, high, row[one], ptr[one])

        for b in batches:
            row = b.column(0).to_numpy()
            for i, j, w in _texts(b, bits, True, poly):
                for n, at, (fp, chk) in _candidates(w, orders, have.value):
                    chk, at_row = chk.view(np.int64), row[i:j][w.doc[at]]
                    if n:
                        cols.append((fp, chk, at_row, w.pointer(at, n)))
                    else:  # all words of the text
                        yield batch(fp.view(np.int64), np.diff(np.append(at, len(w.s))), chk, chk, at_row, w.pointer(at, n))
                words += len(w.s)
                if words >= FLUSH_WORDS:
                    yield flush()
                    cols, words = [], 0
        if cols:
            yield flush()

    return (rows.mapInArrow(run, FOUND).groupBy("fp")
            .agg(F.sum("c").alias("c"), F.min("chk_min").alias("chk_min"), F.max("chk_max").alias("chk_max"),
                 F.min_by("ptr", "row").alias("ptr"), F.min("row").alias("row")))


PHRASES = "lang string, words int, phrase string, f long"


def _phrases(rows: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """The texts behind the pointers (PHRASES), read from the rows pointed to; no other text becomes a phrase."""
    wanted = found.groupBy("row").agg(F.collect_list(F.struct("ptr", "fp", "c", F.col("chk_min").alias("chk"))).alias("at"))
    # rows of one hash are one row (repeated rows collapse before the shuffle), unless their texts differ
    once = rows.withColumn("other", F.hash("text")).dropDuplicates(["row", "other"]).drop("other")

    def run(batches):
        poly = Polynomials()
        for b in batches:
            for i, j, w in _texts(b, bits, True, poly):
                at = b.column(3).slice(i, j - i)
                flat = at.flatten()
                ptr, fp, c, chk = (flat.field(k).to_numpy() for k in range(4))
                doc = np.repeat(np.arange(j - i), np.diff(at.offsets.to_numpy()))
                key = w.off[doc] + (ptr >> WORD_BITS)
                first = np.searchsorted(w.s, key)
                for n in np.unique(ptr & ((1 << WORD_BITS) - 1)).tolist():
                    m = ((ptr & ((1 << WORD_BITS) - 1)) == n) & (first + max(n, 1) <= len(w.s))
                    m[m] = w.s[first[m]] == key[m]
                    have, fps = w.ngrams(n)
                    k = np.minimum(np.searchsorted(have, first[m]), max(len(have) - 1, 0))
                    ok = (have[k] == first[m]) & (fps[0][k].view(np.int64) == fp[m]) & (fps[1][k].view(np.int64) == chk[m])
                    m[m] = ok  # a pointer into another row of the same hash finds something else
                    lang = b.column(1).slice(i, j - i).take(pa.array(doc[m]))
                    yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(int(m.sum()), n, np.int32)), w.text(first[m], n), pa.array(c[m])],
                                                     names=["lang", "words", "phrase", "f"])

    return once.join(wanted, "row").mapInArrow(run, PHRASES)


def _spelled(rows: DataFrame, orders: tuple[int, ...], clashing, bits: int) -> DataFrame:
    """(lang, words, phrase, f) of the n-grams whose fingerprint may be a ``clashing`` one, counted by their text."""
    def run(batches):
        poly = Polynomials()
        for b in batches:
            for i, j, w in _texts(b, bits, False, poly):
                for n in orders:
                    at, (fp,) = w.ngrams(n)
                    some = _maybe(clashing.value, fp)
                    at, fp = at[some], fp[some]
                    lang = b.column(1).slice(i, j - i).take(pa.array(w.doc[at]))
                    yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), lang, pa.array(np.full(len(at), n, np.int32)), w.text(at, n)],
                                                     names=["fp", "lang", "words", "phrase"])

    return (rows.mapInArrow(run, "fp long, lang string, words int, phrase string")
            .groupBy("fp", "lang", "words", "phrase").agg(F.count("*").alias("f")))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, max_words: int = 3,
                     fingerprint_bits: int = 64) -> DataFrame:
    """PHRASES: per language all phrases of 1 to ``max_words`` words with at least ``min_count`` contiguous occurrences
    within pieces, and the empty phrase with the number of all words.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends, words are separated by blanks and tabs.  A null
    language is ``und``, a null text is empty; repeated rows count each.  ``fingerprint_bits`` is for tests of clashes.
    """
    sc = docs.sparkSession.sparkContext
    rows, orders = _rows(docs, text_col, lang_col), tuple(range(max_words + 1))
    often = stored(_counts(rows, (1, 2), fingerprint_bits).where(F.col("c") >= min_count).select("fp"))  # its shuffle files go
    have = sc.broadcast(bitmap(often))
    found = stored(_pointers(rows, orders, have, fingerprint_bits)
                   .where((F.col("c") >= min_count) | (F.col("ptr").bitwiseAND((1 << WORD_BITS) - 1) == 0)))
    clear = F.col("chk_min") == F.col("chk_max")
    out = _phrases(rows, found.where(clear), fingerprint_bits)
    clashing = found.where(~clear)
    if not clashing.isEmpty():
        some = sc.broadcast(bitmap(clashing))
        again = _spelled(rows, orders, some, fingerprint_bits).join(clashing.select("fp"), "fp", "left_semi").drop("fp")
        out = out.unionByName(again.where((F.col("f") >= min_count) | (F.col("words") == 0)))
    return stored(out.dropDuplicates(["lang", "phrase"]))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, max_words: int = 3,
                 top: int = 2000, cover_percent: int = 50) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: (lang, rank, phrase, a, l, r, n, score).

    A candidate has a >= ``min_count`` occurrences.  Cut after k words it scores floor(10^6 a^2 / (l r)) with the
    occurrences l, r of its parts; the least cut counts, of equal ones the first.  Candidates inside a longer
    one with 100 f(longer) >= ``cover_percent`` a go.  n is the number of the language's words.  Order: score and a
    descending, then phrase by bytes.  Arithmetic is exact (decimals) below 10^15 occurrences.  An empty table gives no rows.
    """
    if not 2 <= max_words < 1 << WORD_BITS:
        raise ValueError(f"max_words must be 2 to {(1 << WORD_BITS) - 1}")
    all_ = frequent_phrases(docs, text_col, lang_col, min_count, max_words)
    words = F.split("phrase", " ")
    phrases = all_.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), words.alias("w"))
    part = lambda a, k: F.array_join(F.slice("w", a, k), " ")
    longer = (phrases.where("words > 2").select("lang", "a", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("k"))
              .select("lang", "a", "k", "w", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("k") + 1)).alias("i"))
              .select("lang", part(F.col("i"), F.col("k")).alias("phrase"), F.col("a").alias("f"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("f")))
    kept = (phrases.join(longer, ["lang", "phrase"], "left").where(F.col("f").isNull() | (F.col("f") * 100 < F.col("a") * cover_percent))
            .drop("f"))
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    count = lambda name, f: all_.where("words > 0").select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    cuts = cuts.withColumn("score", F.expr(f"({a} * {a} * 1000000BD) div ({l} * {r})"))
    scored = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*"))
    order = lambda *keys: W.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the best of each share of a language first, so that no task ranks more than SHARES * top phrases
    some = (scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
            .withColumn("rank", F.row_number().over(order("lang", "share"))).where(F.col("rank") <= top).drop("rank", "share"))
    best = some.withColumn("rank", F.row_number().over(order("lang"))).where(F.col("rank") <= top)
    total = all_.where("words = 0").select("lang", F.col("f").alias("n"))
    return (best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
            .orderBy("lang", "rank"))

"""Token sequences over ordered documents.

The reference holds one 1-D array for the whole corpus.  Here a corpus is a
*packed* table, one row per document::

    packed(doc_id BIGINT, toks ARRAY<T>)          T = STRING (chars) or INT (ids)

Document order (``doc_id``) is the sequence order.  Global positions are an
exclusive prefix sum of ``size(toks)`` computed in two levels
(``functions.scan``), never a global ``row_number`` over tokens; the long form
``(doc_id, pos, gpos, tok)`` is produced only where an operator needs it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.det import hash60
from corpusloom.functions.scan import id_chunk, lag_tail_across, lead_across, running_agg
from corpusloom.session import cut_lineage

#: documents per chunk for the two-level scans over the document table
DOC_CHUNK = 4096
#: largest window-bucket table D4 broadcasts
WINDOW_BROADCAST_ROWS = 1 << 21


def pack_chars(docs: DataFrame, text: str = "text", terminator: str | None = "\n",
               id_col: str = "doc_id") -> DataFrame:
    """One row per document with its characters (code points) as an array.

    ``terminator`` is appended to each text first (the corpus convention of
    one newline after each document); a null text is an empty text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    if terminator is not None:
        t = F.concat(t, F.lit(terminator))
    return docs.select(F.col(id_col).alias("doc_id"), F.split(t, "", -1).alias("toks"))


def global_positions(packed: DataFrame, width: int = DOC_CHUNK) -> DataFrame:
    """Add ``n`` (tokens in the document) and ``off`` (global position of its
    first token).  Empty documents are dropped; they hold no position."""
    d = packed.withColumn("n", F.size("toks").cast("bigint")).filter(F.col("n") > 0)
    # The scan runs on the narrow (doc_id, n) projection; its one-row-per-document
    # result is joined back, so token arrays never ride through the scan's shuffles.
    offs = running_agg(d.select("doc_id", "n"), "n", ["doc_id"], "off", id_chunk("doc_id", width),
                       inclusive=False)
    return d.join(offs.select("doc_id", F.col("off").cast("bigint").alias("off")), "doc_id")


def total_tokens(packed: DataFrame) -> int:
    """Number of tokens in the corpus (one scalar to the driver)."""
    v = packed.select(F.sum(F.size("toks")).cast("bigint").alias("n")).first()["n"]
    return int(v or 0)


def split_point(total: int, frac: float = 0.9) -> int:
    """First ``int(frac * N)`` tokens are train, the rest validation."""
    return int(math.floor(frac * total))


def split_col(gpos: Column, n_train: int) -> Column:
    return F.when(gpos < F.lit(n_train), F.lit("train")).otherwise(F.lit("val"))


def doc_sizes(packed: DataFrame) -> DataFrame:
    """``(doc_id, n)`` of the documents with tokens, stored as a narrow table in the
    checkpoint folder: the split cut and the corpus length read it, not the texts."""
    n = F.size("toks").cast("bigint")
    return cut_lineage(packed.select("doc_id", n.alias("n")).filter(F.col("n") > 0))


def split_cut(sizes: DataFrame, n_train: int, fan: int = 1024) -> tuple[int, int] | None:
    """D2 as two scalars: ``(doc_id, offset)`` of the token at position ``n_train``,
    the first of the validation split; None if the sequence ends before it.

    Sums of ``fan`` equal id ranges are taken, the range that holds the cut is
    cut into ``fan`` ranges again, and so on until one id is left: at most
    seven passes over ``sizes`` for any 64-bit ids, ``fan`` rows to the driver
    in each, and no window.  Ids are unique.
    """
    ends = sizes.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if ends["lo"] is None:
        return None
    lo, hi, rest = int(ends["lo"]), int(ends["hi"]), n_train
    while True:
        step = max(1, -(-(hi - lo + 1) // fan))
        bucket = F.expr(f"(cast(doc_id as decimal(20,0)) - cast('{lo}' as decimal(20,0))) div cast({step} as decimal(20,0))")
        rows = (sizes.filter(F.col("doc_id").between(lo, hi)).groupBy(bucket.alias("b"))
                .agg(F.sum("n").alias("n")).collect())
        for b, n in sorted((int(r["b"]), int(r["n"])) for r in rows):
            if rest < n:
                break
            rest -= n
        else:
            return None
        lo, hi = lo + b * step, min(hi, lo + (b + 1) * step - 1)
        if lo == hi:
            return lo, rest


def split_spans(positioned: DataFrame, n_train: int) -> DataFrame:
    """D2 per document: ``(doc_id, split, tokens, first_gpos, last_gpos)`` from the
    narrow ``(doc_id, n, off)`` alone; the document that holds the cut has two rows."""
    ntr = F.lit(n_train).cast("bigint")
    end = F.col("off") + F.col("n")
    sides = F.array(F.struct(F.lit("train").alias("split"), F.col("off").alias("a"), F.least(end, ntr).alias("b")),
                    F.struct(F.lit("val").alias("split"), F.greatest(F.col("off"), ntr).alias("a"), end.alias("b")))
    return (positioned.select("doc_id", F.inline(sides)).filter(F.col("a") < F.col("b"))
            .select("doc_id", "split", (F.col("b") - F.col("a")).alias("tokens"),
                    F.col("a").alias("first_gpos"), (F.col("b") - 1).alias("last_gpos")))


def split_pieces(packed: DataFrame, cut: tuple[int, int] | None) -> DataFrame:
    """``(split, doc_id, toks)``: whole documents on their side of the cut, the
    document that holds it as two rows.  Map-only; empty rows go."""
    if cut is None:
        return packed.select(F.lit("train").alias("split"), "doc_id", "toks").filter(F.size("toks") > 0)
    doc, off = cut
    n = F.size("toks")

    def side(name: Column, toks: Column) -> Column:
        return F.struct(name.alias("split"), toks.alias("toks"))

    whole = F.array(side(F.when(F.col("doc_id") < doc, F.lit("train")).otherwise(F.lit("val")), F.col("toks")))
    halves = F.array(side(F.lit("train"), F.slice("toks", 1, off)),
                     side(F.lit("val"), F.slice("toks", off + 1, F.greatest(n - off, F.lit(0)))))
    return (packed.select("doc_id", F.inline(F.when(F.col("doc_id") == doc, halves).otherwise(whole)))
            .select("split", "doc_id", "toks").filter(F.size("toks") > 0))


def count_targets(packed: DataFrame, k: int, cut: tuple[int, int] | None, width: int = DOC_CHUNK) -> DataFrame:
    """Distinct ``(split, ctx ARRAY<T>, tgt T)`` of the sequence with their number ``m``:
    ``aggregate_targets(targets(...))`` without positions and without moving tokens.

    A target with ``k`` predecessors in its own document is counted where the
    document is read: the ``k + 1`` shifted slices are zipped and exploded into
    plain columns and pre-aggregated in the same task.  The first ``k`` targets
    of each document need its neighbours' ends: only the first and last ``k``
    tokens per document are shuffled for them (a table of heads and tails).
    Contexts stay inside their split.
    """
    pieces = split_pieces(packed, cut)
    n = F.size("toks")
    cols = [f"t{s}" for s in range(1, k + 2)]
    inner = (pieces.filter(n > k)
             .select("split", *[F.slice("toks", s, n - k).alias(c) for s, c in enumerate(cols, 1)])
             .select("split", F.inline(F.arrays_zip(*cols)))
             .groupBy("split", *cols).agg(F.count(F.lit(1)).alias("m")))
    ends = pieces.select("split", "doc_id", F.slice("toks", 1, k).alias("head"),
                         F.slice("toks", F.greatest(n - k + 1, F.lit(1)), k).alias("tail"))
    carried = lag_tail_across(cut_lineage(ends), "tail", ["doc_id"], "carry", id_chunk("doc_id", width), k, keys=["split"])
    edge = (carried.select("split", F.concat("carry", "head").alias("s"), F.size("carry").alias("c"),
                           F.explode(F.sequence(F.lit(0), F.size("head") - 1)).alias("i"))
            .filter(F.col("c") + F.col("i") > 0)
            .select("split", *[F.get("s", F.col("c") + F.col("i") - (k + 1 - s)).alias(c)
                               for s, c in enumerate(cols, 1)], F.lit(1).cast("bigint").alias("m")))
    g = inner.unionByName(edge).groupBy("split", *cols).agg(F.sum("m").alias("m"))
    return g.select("split", F.array_compact(F.array(*cols[:-1])).alias("ctx"), F.col(cols[-1]).alias("tgt"), "m")


def explode_positions(positioned: DataFrame) -> DataFrame:
    """Long form ``(doc_id, pos, gpos, tok)`` of a positioned packed table."""
    return positioned.select(
        "doc_id", "off", F.posexplode("toks").alias("pos", "tok")
    ).select("doc_id", F.col("pos").cast("bigint").alias("pos"),
             (F.col("off") + F.col("pos")).alias("gpos"), "tok")


def split_by_position(positioned: DataFrame, n_train: int) -> DataFrame:
    """D2 in long form: every token with its split."""
    return explode_positions(positioned).withColumn("split", split_col(F.col("gpos"), n_train))


def with_carry(positioned: DataFrame, k: int, width: int = DOC_CHUNK) -> DataFrame:
    """Add ``carry``: the last ``k`` tokens of the sequence before each document."""
    n = F.size("toks")
    tails = positioned.select(
        "doc_id", F.when(n <= k, F.col("toks")).otherwise(F.slice("toks", n - k + 1, k)).alias("__tail"))
    carry = lag_tail_across(tails, "__tail", ["doc_id"], "carry", id_chunk("doc_id", width), k)
    return positioned.join(carry.select("doc_id", "carry"), "doc_id")


def targets(positioned: DataFrame, k: int, n_train: int, width: int = DOC_CHUNK) -> DataFrame:
    """Every token that has at least one predecessor inside its own split, with its
    context of up to ``k`` previous tokens (clipped at the split start)::

        (split STRING, gpos BIGINT, ctx ARRAY<T>, tgt T)

    Built per document from ``concat(carry, toks)``: the j-th previous token
    of every position is one shifted slice, the k slices are zipped and
    exploded natively (no lambdas, no self-join), O(n*k) per document.
    """
    elem = positioned.schema["toks"].dataType.elementType
    d = with_carry(positioned, k, width)
    pad = F.concat(F.array_repeat(F.lit(None).cast(elem), k), F.col("carry"), F.col("toks"))
    c = F.size("carry")
    shifted = [F.slice(pad, k + c - s + 1, F.size("toks")).alias(f"p{s}") for s in range(1, k + 1)]
    z = d.select("off", F.col("toks").alias("t"), *shifted)
    z = z.select("off", F.posexplode(F.arrays_zip("t", *[f"p{s}" for s in range(1, k + 1)])).alias("i", "z"))
    ntr = F.lit(n_train).cast("bigint")
    g = F.col("off") + F.col("i")
    z = z.select(g.alias("gpos"), "z")
    start = F.when(F.col("gpos") < ntr, F.lit(0).cast("bigint")).otherwise(ntr)
    L = F.least(F.lit(k).cast("bigint"), F.col("gpos") - start).cast("int")
    full = F.array(*[F.col(f"z.p{s}") for s in range(k, 0, -1)])
    return (z.withColumn("L", L).filter(F.col("L") > 0)
            .select(split_col(F.col("gpos"), n_train).alias("split"), "gpos",
                    F.slice(full, F.lit(k) - F.col("L") + 1, F.col("L")).alias("ctx"),
                    F.col("z.t").alias("tgt")))


def next_token(positioned: DataFrame, n_train: int, width: int = DOC_CHUNK) -> DataFrame:
    """(gpos, tok, nxt, split) for every adjacent pair of the sequence.  The
    last token of a document pairs with the first of the next; a pair belongs
    to a split only if both ends do (pairs across the split are dropped)."""
    firsts = positioned.select("doc_id", F.element_at("toks", 1).alias("__first"))
    nxt_first = lead_across(firsts, "__first", ["doc_id"], "__next_first", id_chunk("doc_id", width))
    d = positioned.join(nxt_first.select("doc_id", "__next_first"), "doc_id")
    nxt = F.concat(F.slice("toks", 2, F.greatest(F.col("n") - 1, F.lit(0)).cast("int")),
                   F.when(F.col("__next_first").isNull(), F.array())
                   .otherwise(F.array("__next_first")))
    pairs = (d.select("off", F.col("toks").alias("a"), nxt.alias("b"))
             .select("off", F.posexplode(F.arrays_zip("a", "b")).alias("i", "p")))
    ntr = F.lit(n_train).cast("bigint")
    return (pairs.filter(F.col("p.b").isNotNull())
            .select((F.col("off") + F.col("i")).alias("gpos"),
                    F.col("p.a").alias("tok"), F.col("p.b").alias("nxt"))
            .filter((F.col("gpos") + 1 < ntr) | (F.col("gpos") >= ntr))
            .withColumn("split", split_col(F.col("gpos"), n_train)))


# --------------------------------------------------------------------------
# Random windows
# --------------------------------------------------------------------------

def sample_starts(spark, split_len: int, block: int, batch: int, steps: int, seed: int,
                  split: str, first_step: int = 0) -> DataFrame:
    """D3: ``batch`` window starts per step, uniform in ``[0, split_len - block)``.

    Draws are keyed by (seed, split, it, row), so they do not depend on the
    partitioning.  Fails, like the reference, when the split is not longer
    than the block.
    """
    if split_len - block <= 0:
        raise ValueError(
            f"split '{split}' has {split_len} tokens, not more than block_size={block}")
    rows = spark.range(0, steps * batch)
    it = (F.floor(F.col("id") / batch) + first_step).cast("int")
    row = (F.col("id") % batch).cast("int")
    return rows.select(
        F.lit(split).alias("split"), it.alias("it"), row.alias("row"),
        F.pmod(hash60(seed, split, it, row), F.lit(split_len - block)).cast("bigint").alias("start"),
    )


def gather_windows(positioned: DataFrame, starts: DataFrame, block: int, split_base: int = 0,
                   width: int = DOC_CHUNK) -> DataFrame:
    """x = seq[s : s+block], y = seq[s+1 : s+1+block] for every start.

    ``start`` is relative to its split, whose first global position is
    ``split_base``.  A range join recast as an equi-join: a window covers
    ``block+1`` positions, so it touches at most two buckets of that width;
    documents are expanded to the buckets they cover (no token arrays carried),
    matched against the bounded window table, then only the matched documents'
    tokens are sliced.
    """
    W = block + 1
    win = starts.select("split", "it", "row", (F.col("start") + split_base).alias("s"))
    win_b = win.select("*", F.explode(F.array_distinct(F.array(
        F.floor(F.col("s") / W), F.floor((F.col("s") + block) / W)))).alias("b"))
    spans = positioned.select(
        "doc_id", "off", "n",
        F.explode(F.sequence(F.floor(F.col("off") / W),
                             F.floor((F.col("off") + F.col("n") - 1) / W))).alias("b"))
    # The window side has at most 2 rows per window (batch * steps windows):
    # broadcast it when that count is below the limit, else a shuffle join.
    small = 2 * starts.count() <= WINDOW_BROADCAST_ROWS
    hits = (spans.join(F.broadcast(win_b) if small else win_b, "b")
            .filter((F.col("off") <= F.col("s") + block) & (F.col("off") + F.col("n") > F.col("s")))
            .select("split", "it", "row", "s", "doc_id", "off", "n").distinct())
    toks = positioned.select("doc_id", "toks")
    lo = F.greatest(F.col("s"), F.col("off"))
    hi = F.least(F.col("s") + block, F.col("off") + F.col("n") - 1)
    parts = (hits.join(toks, "doc_id")
             .select("split", "it", "row", "s", "off",
                     F.slice("toks", (lo - F.col("off") + 1).cast("int"), (hi - lo + 1).cast("int")).alias("seg")))
    w = (parts.groupBy("split", "it", "row", "s")
         .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("off", "seg"))),
                                    lambda x: x["seg"])).alias("win")))
    return w.select("split", "it", "row", (F.col("s") - split_base).alias("start"),
                    F.slice("win", 1, block).alias("x"), F.slice("win", 2, block).alias("y"))

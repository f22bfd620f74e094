"""Character tokenizer (C1-C3) and tokenizer statistics / listings.

A vocabulary is ``vocab(id INT, token STRING)``: dense ids from 0.  A char
vocabulary has at most one row per Unicode code point (0x110000), which is the
proven bound that lets us broadcast it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: a char vocabulary cannot exceed the number of Unicode code points
MAX_CHAR_VOCAB = 0x110000


def char_vocab(docs: DataFrame, text: str = "text", terminator: str | None = None) -> DataFrame:
    """Distinct code points, ascending, ids from 0.

    Each document is reduced to its distinct characters before the shuffle
    (plus map-side partial aggregation), so the exchange carries at most
    V rows per task.  Ordering the final V rows on one partition is safe:
    V is bounded by the code-point count.
    """
    t = F.col(text) if terminator is None else F.concat(F.col(text), F.lit(terminator))
    chars = docs.select(F.explode(F.array_distinct(F.split(t, "", -1))).alias("token")).distinct()
    return chars.select(
        (F.row_number().over(Window.orderBy("token")) - 1).cast("int").alias("id"), "token")


def char_encode(packed: DataFrame, vocab: DataFrame, on_unknown: str = "error") -> DataFrame:
    """``packed(doc_id, toks ARRAY<STRING>)`` -> ``(doc_id, pos, id)``.

    The vocabulary is broadcast (bounded, see module doc), so tokens are never
    shuffled.  ``on_unknown='error'`` raises on a character missing from the
    vocabulary (the reference's KeyError); ``'drop'`` leaves it out.
    """
    long = packed.select("doc_id", F.posexplode("toks").alias("pos", "token"))
    j = long.join(F.broadcast(vocab), "token", "left")
    if on_unknown == "error":
        idc = F.when(F.col("id").isNull(),
                     F.raise_error(F.concat(F.lit("character not in vocabulary: "), F.col("token"))))\
               .otherwise(F.col("id"))
        j = j.withColumn("id", idc.cast("int"))
    elif on_unknown == "drop":
        j = j.filter(F.col("id").isNotNull())
    else:
        raise ValueError(on_unknown)
    return j.select("doc_id", F.col("pos").cast("int").alias("pos"), "id")


def _runs(key: str):
    """Map side of ``char_decode``: neighbouring rows of one key with consecutive positions become one row (key, pos, n, text).

    Tokens other than single characters are runs of their own, so a run of n > 1 rows has n characters."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not b.num_rows:
                continue
            keys, pos, token = b.column(0), b.column(1), pc.fill_null(b.column(2), "")
            code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            at = pc.fill_null(pos, -1).to_numpy().astype(np.int64)
            one = (pc.utf8_length(token).to_numpy() == 1) & (at >= 0)
            same = (code[1:] == code[:-1]) & (at[1:] == at[:-1] + 1) & one[1:] & one[:-1]
            first = np.flatnonzero(np.r_[True, ~same])
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)], pa.int32()), token), "")
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(first)), pos.take(pa.array(first)).cast(pa.int64()),
                                              pa.array(np.diff(np.r_[first, len(at)]), pa.int32()), text], [key, "pos", "n", "text"])

    return run


def char_decode(tokens: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, pos, id)`` -> ``(key, text)``: tokens in position order, joined.

    Rows that stand beside each other are joined before the shuffle, which so carries text and not a row per token.
    Runs that overlap (a key that was encoded twice) are cut into tokens again and ordered by (pos, token).
    One output row per key, so one group holds exactly the characters of one
    output string (a row-sized, not table-sized, group).
    """
    j = tokens.join(F.broadcast(vocab), "id", "left").select(key, "pos", "token")
    kind = tokens.schema[key].dataType.simpleString()
    runs = (j.mapInArrow(_runs(key), f"`{key}` {kind}, pos long, n int, text string")
            .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "n", "text"))).alias("runs")))
    then = F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0)))
    apart = F.forall(F.zip_with(F.slice("runs", 1, F.size("runs") - 1), then, lambda x, y: F.coalesce(x["pos"] + x["n"] <= y["pos"], F.lit(False))), lambda x: x)
    cut = F.flatten(F.transform("runs", lambda r: F.transform(
        F.when(r["n"] > 1, F.split(r["text"], "", -1)).otherwise(F.array(r["text"])), lambda c, i: F.struct((r["pos"] + i).alias("pos"), c.alias("token")))))
    return runs.select(key, F.array_join(F.transform(F.when(apart, F.transform("runs", lambda r: F.struct(r["pos"], r["text"].alias("token"))))
                                                     .otherwise(F.array_sort(cut)), lambda x: x["token"]), "").alias("text"))


def tokenizer_stats(vocab_size: int, per_doc: DataFrame, block_size: int, kind: str = "char",
                    chars: str = "chars", tokens: str = "tokens") -> DataFrame:
    """C11: (tokenizer, vocab_size, chars, tokens, chars_per_token, context_chars)
    from one table of per-document character and token counts, in one
    aggregate (map-side partial sums)."""
    t = per_doc.agg(F.sum(chars).cast("bigint").alias("chars"), F.sum(tokens).cast("bigint").alias("tokens"))
    cpt = F.col("chars") / F.col("tokens")
    return t.select(
        F.lit(kind).alias("tokenizer"), F.lit(vocab_size).cast("bigint").alias("vocab_size"),
        "chars", "tokens", F.round(cpt, 6).alias("chars_per_token"),
        F.round(F.lit(block_size) * cpt, 0).cast("bigint").alias("context_chars"))


def vocab_listing(vocab: DataFrame, special: list[str] | None = None,
                  unk: str = "<unk>") -> DataFrame:
    """Tokens by id with their type: UNKNOWN for ``<unk>``, CONTROL for other
    special tokens, NORMAL otherwise."""
    special = special or []
    typ = (F.when(F.col("token") == unk, F.lit("UNKNOWN"))
           .when(F.col("token").isin(special) if special else F.lit(False), F.lit("CONTROL"))
           .otherwise(F.lit("NORMAL")))
    return vocab.select("id", "token", typ.alias("type"))


def merge_listing(merges: DataFrame) -> DataFrame:
    """Merges as ``"left right"`` strings by rank."""
    return merges.select("rank", F.concat_ws(" ", "left", "right").alias("merge"))


def special_ids(vocab: DataFrame, unk: str = "<unk>") -> DataFrame:
    """Unk / bos / eos ids; all three are ``<unk>`` in the reference export."""
    u = vocab.filter(F.col("token") == unk).select("id")
    return u.select(F.col("id").alias("unk_id"), F.col("id").alias("bos_id"), F.col("id").alias("eos_id"))

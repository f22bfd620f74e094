"""Preference formatting of chosen and rejected conversations (native).

The longest common prefix of turns is rendered once, as the prompt; what
follows on either side is rendered as that side's completion, with the spans a
loss may train on (assistant turns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, TAIL = "<|{role}|>\n", "<|end|>\n"


def gather_turns(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<role,text>>), turns in the order of turn, role, text with nulls first.

    A conversation is one training example, so it has to fit in a row.  Null
    roles and texts count as empty, repeated turns stay repeated, and a null
    conversation id is an id like any other.
    """
    rows = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                                                F.coalesce("text", F.lit("")).alias("text"))))
    return turns.groupBy(F.col(conv_id).alias("conv")).agg(
        F.transform(rows, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def echo_negative(turns: Column) -> Column:
    """The conversation with its last assistant turn replaced by the user turn before it (or by nothing).

    A conversation without an assistant turn is its own negative.
    """
    where = lambda role, below: F.array_max(F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (turns[i]["role"] == role) & (i < below)))
    last = where("assistant", F.size(turns))
    asked = where("user", last)
    said = F.when(asked.isNull(), F.lit("")).otherwise(turns[asked]["text"])
    return F.transform(turns, lambda t, i: F.when(i == last, F.struct(t["role"].alias("role"), said.alias("text"))).otherwise(t))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns, from the first on, are equal in both."""
    n = F.least(F.size(a), F.size(b))
    differ = F.array_min(F.filter(F.sequence(F.lit(0), n), lambda i: (i == n) | (a[i] != b[i])))
    return F.coalesce(differ, F.lit(0))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(TAIL))


def trained_spans(turns: Column) -> Column:
    """[start, end) code points of the assistant turns' text and end mark in the rendered turns."""
    size = F.transform(turns, lambda t: F.char_length(rendered(t)))
    ends = F.transform(size, lambda _, i: F.aggregate(F.slice(size, F.lit(1), i + 1), F.lit(0), lambda s, x: s + x))
    spans = F.transform(turns, lambda t, i: F.struct(
        t["role"].alias("role"),
        (ends[i] - F.char_length(t["text"]) - len(TAIL)).alias("start"), ends[i].alias("end")))
    return F.transform(F.filter(spans, lambda s: s["role"] == "assistant"),
                       lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """One row per pair (pair_id, chosen, rejected: array<struct<role,text>>).

    Returns (pair_id, n_prefix, prompt, chosen, rejected, chosen_mask,
    rejected_mask): rendered strings, and masks as arrays of trained spans
    within the completion.  Null sides are empty.  If one side is a prefix of
    the other, its completion is empty; equal sides give two empty completions.
    """
    empty = F.from_json(F.lit("[]"), "array<struct<role:string,text:string>>")
    p = pairs.select("pair_id", F.coalesce("chosen", empty).alias("a"), F.coalesce("rejected", empty).alias("b"))
    p = p.withColumn("n", common_turns(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    p = p.select("pair_id", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), rest(F.col("a")).alias("a"), rest(F.col("b")).alias("b"))
    text = lambda c: F.array_join(F.transform(F.col(c), rendered), "")
    return p.select("pair_id", F.col("n").cast("long").alias("n_prefix"), text("p").alias("prompt"),
                    text("a").alias("chosen"), text("b").alias("rejected"),
                    trained_spans(F.col("a")).alias("chosen_mask"), trained_spans(F.col("b")).alias("rejected_mask"))

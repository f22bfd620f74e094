"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups.

Only narrow rows (hash, id, length) meet for the decision.  The texts move
once, for the byte comparison: they are pre-aggregated by (hash, bytes) before
the shuffle, so a group of copies crosses the network once per map task and is
never gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import stored

WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: str | Column) -> Column:
    """The text without white space [\\x20\\x09-\\x0D]; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(c, F.lit("")), WHITE_SPACE, "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content: Column | None = None, hash128=F.md5) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    Rows are equal when ``content`` (default: the text without white space) has
    equal bytes.  Of equal rows the one with the most code points in the
    original text stays, then the smallest id; a null id comes after all others.
    Null texts are empty texts, and all empty texts are one group.  Repeated
    (id, text) rows are one group too, and every one of them that carries the
    id of the row that stays is marked ``kept``.  Other columns are not read.
    ``hash128`` groups; SHA-256 separates texts whose hash collides, and the
    byte comparison raises should two different texts share both.
    """
    content = normalised(text_col) if content is None else content
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), content.alias("__norm"))
    key = [hash128("__norm").alias("__h"), F.sha2("__norm", 256).alias("text_sha256")]
    distinct_texts = (base.select(hash128("__norm").alias("__h"), "__norm")
                      .groupBy("__h", "__norm").agg(F.count("*").alias("__c")))
    checked = (distinct_texts.select("__h", F.sha2("__norm", 256).alias("text_sha256"), "__c")
               .groupBy("__h", "text_sha256").agg(F.count("*").alias("__texts"), F.sum("__c").alias("group_size"))
               .select("__h", "text_sha256", F.when(F.col("__texts") == 1, F.col("group_size")).otherwise(
                   F.raise_error(F.lit("two texts share both hashes")).cast("long")).alias("group_size")))
    narrow = base.select("__id", F.char_length(F.coalesce("__text", F.lit(""))).alias("__n"), *key)
    best = (narrow.groupBy("__h", "text_sha256")
            .agg(F.min(F.struct(-F.col("__n"), F.col("__id").isNull(), "__id")).alias("__b")))
    # the keep decision and the byte check share one partitioning by (hash, sha)
    groups = best.join(checked, ["__h", "text_sha256"]).select(
        "__h", "text_sha256", "group_size", F.col("__b.__id").alias("keep_id"))
    return narrow.join(groups, ["__h", "text_sha256"]).select(
        F.col("__id").alias(id_col), "keep_id", "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def one_row_per_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of ``docs`` per group of equal texts, with its columns.

    It is the one that ``exact_dedup`` keeps.  Where several rows carry the kept id (rows ingested
    twice, groups without ids), the one with the most code points stays, then the least text, then
    the least by all columns.
    """
    decided = stored(exact_dedup(docs, id_col, text_col).select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"), "kept"))
    gone = decided.where("not kept").select("__id", "__sha").distinct()
    again = stored(decided.where("kept").groupBy("__id", "__sha").count().where("count > 1").select("__id", "__sha"))
    sha = F.sha2(normalised(docs[text_col]), 256)

    def same(keys: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(keys["__id"]) & (sha == keys["__sha"])

    single = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return single
    single = docs.join(decided.where("not kept").select("__id", "__sha").unionByName(again).distinct().alias("out"),
                       docs[id_col].eqNullSafe(F.col("out.__id")) & (sha == F.col("out.__sha")), "left_anti")
    row = F.struct(*[docs[c] for c in docs.columns])
    order = F.struct(-F.char_length(F.coalesce(docs[text_col], F.lit(""))), docs[text_col], F.to_json(row))
    first = (docs.join(again, same(again), "left_semi").groupBy(sha.alias("__sha"))  # a kept text has one id
             .agg(F.min_by(row, order).alias("__row")).select("__row.*"))
    return single.unionByName(first)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns (repeated rows with the id that stays all do)."""
    gone = (exact_dedup(docs, id_col, text_col).where("not kept")
            .select(F.col(id_col).alias("__gone"), F.col("text_sha256").alias("__sha")).distinct())
    same = docs[id_col].eqNullSafe(F.col("__gone")) & (F.sha2(normalised(docs[text_col]), 256) == F.col("__sha"))
    return docs.join(gone, same, "left_anti")

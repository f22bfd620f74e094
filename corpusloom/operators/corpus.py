"""Corpus assembly.

The reference joins whole books into one string.  Here the corpus stays a
table of pieces in order; separators are carried as text and every piece gets
its global character offset, so no string of corpus size is ever built and no
work (however large) is gathered into one row or one task.

    corpus(ord INT, work_id BIGINT, doc_id BIGINT, text STRING, char_off BIGINT)

A work is made of documents in ``doc_id`` order, joined by ``doc_sep``; works
are joined by ``work_sep`` (``"\\n\\n\\n"``) and the corpus ends with ``end``
(``"\\n"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.clean import strip_boilerplate
from corpusloom.functions.scan import running_agg

PIECE_CHUNK = 4096


def clean_documents(df: DataFrame, col: str = "text", out: str = "body") -> DataFrame:
    """B6 over a table: one projection of native regex expressions."""
    return df.withColumn(out, strip_boilerplate(F.col(col)))


def work_report(pieces: DataFrame, title: str = "title", body: str = "body") -> DataFrame:
    """Cleaned characters per work plus the corpus total (``title`` null).

    ``rollup`` keeps it one aggregation with map-side partial sums, so a work
    holding a third of all rows costs no more than any other.
    """
    return (pieces.rollup(title)
            .agg(F.sum(F.length(body)).cast("bigint").alias("chars"))
            .select(F.col(title).alias("title"), "chars"))


def assemble_corpus(pieces: DataFrame, work_sep: str = "\n\n\n", end: str = "\n",
                    doc_sep: str = "\n", body: str = "body",
                    width: int = PIECE_CHUNK) -> DataFrame:
    """``pieces(ord, work_id, doc_id, body)`` -> corpus with separators and
    global offsets.  The last piece of each work is found on the small
    per-work table; offsets are a two-level prefix sum over (ord, doc_id)."""
    # One row per work: its last document and the corpus's greatest ord (a
    # window over the works table, which has one row per work).
    last = (pieces.groupBy("ord").agg(F.max("doc_id").alias("__last"))
            .withColumn("__maxord", F.max("ord").over(Window.partitionBy(F.lit(1)))))
    p = pieces.join(last, "ord")  # AQE broadcasts it when measured small
    sep = (F.when(F.col("doc_id") != F.col("__last"), F.lit(doc_sep))
           .when(F.col("ord") != F.col("__maxord"), F.lit(work_sep))
           .otherwise(F.lit(end)))
    p = p.withColumn("text", F.concat(F.col(body), sep)).withColumn("__len", F.length("text"))
    chunk = F.struct(F.col("ord"), F.floor(F.col("doc_id") / width))
    out = running_agg(p, "__len", ["ord", "doc_id"], "char_off", chunk, inclusive=False)
    return out.select(F.col("ord").cast("int").alias("ord"), "work_id", "doc_id", "text",
                      F.col("char_off").cast("bigint").alias("char_off"))

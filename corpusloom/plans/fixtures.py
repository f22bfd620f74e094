"""Derived inputs, built by Spark from the driver tables (so every registered
query's work grows with them).  ``plans.oracle`` builds the same tables in
DuckDB SQL; the two definitions must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.scan import rank_within
from corpusloom.session import cut_lineage
from corpusloom.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values shared with the SQL oracle: marker-wrapping of documents by
# doc_id % 6 (both markers / START only / END only / outer blanks /
# credit + notes / two STARTs).
# ---------------------------------------------------------------------------
S0 = "*** START OF THE PROJECT GUTENBERG EBOOK "
S1 = "*** START OF THIS PROJECT GUTENBERG EBOOK "
E0 = "*** END OF THE PROJECT GUTENBERG EBOOK "
E1 = "*** END OF THIS PROJECT GUTENBERG EBOOK "
LICENCE = "End of the licence text.\n"
CREDIT_TOP = "Produced by Jane Roe and a volunteer team\n"
NOTES = "\n[Illustration: a ship at sea]\n[Transcriber's Note: spelling kept]"
CREDIT_PGDP = "\nProduced by J. Roe at https://www.pgdp.net online\n(This file was\nmade from scans)\nThe end."
PREFACE = "Preface\n"
# ---------------------------------------------------------------------------

NO_SOURCE = "(no source)"  # the work of documents without a source


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """works(work_id BIGINT, title STRING, ord INT): distinct sources ranked by name; a null source is a work too."""
    return _works(documents(spark, sf_dir))


def _works(docs: DataFrame) -> DataFrame:
    src = docs.select(F.coalesce("source", F.lit(NO_SOURCE)).alias("source")).distinct()
    r = F.row_number().over(Window.orderBy("source"))
    return src.select(r.cast("bigint").alias("work_id"), F.col("source").alias("title"),
                      r.cast("int").alias("ord"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw(doc_id, source, t): documents wrapped in licence boilerplate by doc_id % 6; a null text is empty."""
    return _raw(documents(spark, sf_dir))


def _raw(d: DataFrame) -> DataFrame:
    d = d.withColumn("source", F.coalesce("source", F.lit(NO_SOURCE)))
    s, t = F.col("source"), F.coalesce("text", F.lit(""))
    nbsp, ideo, fs = "\u00a0", "\u3000", "\u001c"
    k = F.col("doc_id") % 6
    wrapped = (
        F.when(k == 0, F.concat(F.lit(S0), s, F.lit(" ***\n"), t, F.lit("\n"), F.lit(E0), s,
                                F.lit(" ***\n"), F.lit(LICENCE)))
        .when(k == 1, F.concat(F.lit("Title: "), s, F.lit("\n"), F.lit(S1), s, F.lit("\n***\n"), t))
        .when(k == 2, F.concat(t, F.lit("\n\n"), F.lit(E1), s, F.lit(" ***\n"), F.lit(LICENCE)))
        .when(k == 3, F.concat(F.lit(" \t\n" + nbsp), t, F.lit(ideo + "\n " + fs)))
        .when(k == 4, F.concat(F.lit(CREDIT_TOP), t, F.lit(NOTES), F.lit(CREDIT_PGDP)))
        .otherwise(F.concat(F.lit(S0), F.lit("A ***\n" + PREFACE), F.lit(S0), F.lit("B ***\n"), t))
    )
    return d.select("doc_id", "source", wrapped.alias("t"))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pieces(ord, work_id, title, doc_id, body): cleaned raw documents with their work."""
    return pieces_of(documents(spark, sf_dir))


def pieces_of(docs: DataFrame) -> DataFrame:
    from corpusloom.functions.clean import strip_boilerplate
    r, w = _raw(docs), _works(docs)
    return (r.join(w, r["source"] == w["title"])
            .select("ord", "work_id", "title", "doc_id", strip_boilerplate(F.col("t")).alias("body")))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prompts(prompt_id, prompt): every user turn of ``conversations``, whole text."""
    c = read_table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("prompt_id"),
        F.col("text").alias("prompt"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests(req_id, body): JSON request bodies built from ``events``:
    temperature = value / 400, top_k = user_id % 50, max_new_tokens = event_id,
    prompt = event_type; key number ``event_id % 5`` is left out (4 = none left
    out), and bodies of ``event_id % 7 == 6`` are empty."""
    e = read_table(spark, sf_dir, "events")
    m = F.col("event_id") % 5
    fields = [
        F.when(m != 0, F.col("event_type")).alias("prompt"),
        F.when(m != 1, F.col("value") / 400.0).alias("temperature"),
        F.when(m != 2, F.col("user_id") % 50).alias("top_k"),
        F.when(m != 3, F.col("event_id")).alias("max_new_tokens"),
    ]
    body = F.when(F.col("event_id") % 7 == 6, F.lit("")).otherwise(F.to_json(F.struct(*fields)))
    return e.select(F.col("event_id").alias("req_id"), body.alias("body"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """history(run_id, it, train_loss, val_loss, secs) from ``events``: run = user_id,
    it = 250 * (rank by (ts, event_id) - 1), val = value, train = 0.9 * value,
    secs = seconds since the run's first eval.

    The rank is a two-level running count over range partitions of
    (user_id, ts, event_id), so one run holding a third of all events is cut
    into balanced chunks.  The result is materialised as a table in the
    checkpoint folder, as a history table would be.
    """
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    e = e.withColumn("__us", epoch_micros(e, "ts"))
    r = rank_within(e, ["user_id"], ["ts", "event_id"], "__rn")
    first = e.groupBy("user_id").agg(F.min("__us").alias("__t0"))
    r = r.join(first, "user_id")
    return cut_lineage(r.select(F.col("user_id").alias("run_id"),
                    (F.lit(250) * (F.col("__rn") - 1)).cast("int").alias("it"),
                    (F.lit(0.9) * F.col("value")).alias("train_loss"),
                    F.col("value").alias("val_loss"),
                    ((F.col("__us") - F.col("__t0")) / F.lit(1e6)).alias("secs")))


def epoch_micros(df: DataFrame, col: str):
    """Microseconds since 1970-01-01 00:00:00 of a timestamp column, without
    the session time zone for wall-clock (NTZ) timestamps."""
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """runs(run_id, norm, pos, mlp): architecture flags from the bits of user_id."""
    e = read_table(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    return e.select(
        u.alias("run_id"),
        F.when(u.bitwiseAND(1) == 1, "rmsnorm").otherwise("layernorm").alias("norm"),
        F.when(u.bitwiseAND(2) == 2, "rope").otherwise("learned").alias("pos"),
        F.when(u.bitwiseAND(4) == 4, "swiglu").otherwise("gelu").alias("mlp"))

"""Generation as a stream (F9): request rows in, completion rows out.

A Structured Streaming file source of JSON request lines ``{req_id, body}``
feeds ``foreachBatch``: each micro-batch is normalised (F8) and generated
(F6, each request with its own temperature / top-k / length) as one batch
job.  Completions are written under ``out_dir/completions/batch_id=<id>``
with overwrite, so a micro-batch replayed after a failure replaces its own
output and a restart from the checkpoint adds no row.  Bad requests go to
``out_dir/bad/batch_id=<id>``.  No port, no server: the stream is files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.generate import generate
from corpusloom.operators.sampling import normalize_requests
from corpusloom.session import cut_lineage

REQUEST_SCHEMA = "req_id bigint, body string"


def prompt_tokens(prompt: str = "prompt"):
    """Characters of the prompt (an empty prompt has none)."""
    return F.when(F.length(prompt) == 0, F.array().cast("array<string>")).otherwise(F.split(prompt, "", -1))


def complete_requests(requests: DataFrame, counts: DataFrame, vocab: DataFrame, *, k: int = 1,
                      seed: int = 1337, a: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Batch form used by every micro-batch: ``(completions, bad)``."""
    reqs = normalize_requests(requests)
    bad = reqs.filter("bad").select("req_id")
    good = reqs.filter(~F.col("bad"))
    steps = good.agg(F.max("max_new_tokens").alias("m")).first()["m"]
    if steps is None:
        empty = good.select("req_id", F.lit("").alias("completion"))
        return empty, bad
    prompts = good.select(F.col("req_id").alias("prompt_id"), prompt_tokens().alias("toks"),
                          "temperature", "top_k", "max_new_tokens")
    g = generate(prompts, counts, vocab, k=k, steps=int(steps), temperature="temperature",
                 top_k="top_k", n="max_new_tokens", seed=seed, a=a)
    return g.select(F.col("prompt_id").alias("req_id"), F.array_join("new_toks", "").alias("completion")), bad


def generate_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_location: str,
                    counts: DataFrame, vocab: DataFrame, *, k: int = 1, seed: int = 1337, a: float = 1.0,
                    available_now: bool = True) -> StreamingQuery:
    counts = cut_lineage(counts)  # the model is fixed for the life of the stream
    vocab = cut_lineage(vocab)
    src = spark.readStream.schema(REQUEST_SCHEMA).json(source_dir)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        done, bad = complete_requests(df, counts, vocab, k=k, seed=seed, a=a)
        done.write.mode("overwrite").parquet(f"{out_dir}/completions/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{out_dir}/bad/batch_id={batch_id}")

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()

"""Live training monitor (H7): each arriving eval row -> improved?, evals since
the last improvement, stopped?

Keyed state per run with ``applyInPandasWithState`` (append mode, no
timeout).  The state is three numbers per run, so a run holding a third of
all rows costs no more memory than any other; rows of one run inside a
micro-batch are processed in ``it`` order, and rows after the stop are
dropped, as the training loop would never have produced them.  The result
equals ``operators.runs.improvements`` + ``early_stop`` on the same rows.

``monitor_batch`` / ``monitor_tables`` do the same natively for runs whose
micro-batches are too long for one task: the two-level scan of H2 continues from
a state table that is joined in, so no task holds a run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.operators.runs import early_stop

OUT_SCHEMA = ("run_id bigint, it int, val_loss double, improved boolean, "
              "evals_since int, stopped boolean")
STATE_SCHEMA = "best double, since int, stopped boolean"


def _monitor_fn(patience: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, since, stopped = (state.get if state.exists else (math.inf, 0, False))
        rows = pd.concat(list(pdfs)).sort_values("it")
        out = []
        for it, val in zip(rows["it"], rows["val_loss"]):
            if stopped:
                break
            improved = bool(val < best) if not math.isnan(val) else False
            if improved:
                best, since = float(val), 0
            else:
                since += 1
            stop = patience > 0 and since >= patience
            out.append((key[0], int(it), float(val), improved, since, stop))
            stopped = stop
        state.update((float(best), int(since), bool(stopped)))
        if out:
            yield pd.DataFrame(out, columns=["run_id", "it", "val_loss", "improved", "evals_since", "stopped"])

    return fn


def monitor_stream(history_stream: DataFrame, patience: int) -> DataFrame:
    """H7 over a streaming (or batch) ``history(run_id, it, val_loss, ...)``."""
    return history_stream.select("run_id", "it", "val_loss").groupBy("run_id").applyInPandasWithState(
        _monitor_fn(patience), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def monitor_batch(rows: DataFrame, patience: int, state: DataFrame | None = None) -> DataFrame:
    """H7 over one batch: ``(run_id, it, val_loss, improved, evals_since, stopped)``.

    ``state(run_id, best, since, stopped)`` is what earlier batches left; rows of
    runs that have stopped are dropped.  A NaN or null loss never improves.
    """
    h = rows.select("run_id", "it", "val_loss")
    if state is not None:
        h = h.join(state.filter("stopped").select("run_id"), "run_id", "left_anti")
    return early_stop(h, patience, state).select(
        "run_id", "it", "val_loss", "improved", "evals_since", "stopped")


def next_state(out: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The state after a batch, one row per run: ``(run_id, best, since, stopped)``."""
    new = out.groupBy("run_id").agg(
        F.min(F.when(F.col("improved"), F.col("val_loss"))).alias("best"),
        F.max_by("evals_since", "it").cast("bigint").alias("since"), F.max("stopped").alias("stopped"))
    if state is not None:
        old = state.select("run_id", F.col("best").alias("b"), F.col("since").alias("s"), F.col("stopped").alias("x"))
        new = new.join(old, "run_id", "full").select(
            "run_id", F.least("best", "b").alias("best"), F.coalesce("since", "s").alias("since"),
            F.coalesce("stopped", "x").alias("stopped"))
    return new.withColumn("best", F.coalesce("best", F.lit(math.inf)))


def monitor_tables(history_stream: DataFrame, patience: int, out_dir: str, checkpoint_location: str) -> StreamingQuery:
    """H7 as a stream of tables under ``out_dir`` (a shared folder): each micro-batch
    writes ``rows/batch_id=<id>`` and ``state/<id>`` from ``state/<id - 1>``, with
    overwrite, so a batch replayed after a failure gives the same tables."""
    spark = history_stream.sparkSession

    def per_batch(df: DataFrame, batch_id: int) -> None:
        state = spark.read.parquet(f"{out_dir}/state/{batch_id - 1}") if batch_id > 0 else None
        rows_path = f"{out_dir}/rows/batch_id={batch_id}"
        monitor_batch(df, patience, state).write.mode("overwrite").parquet(rows_path)
        next_state(spark.read.parquet(rows_path), state).write.mode("overwrite").parquet(f"{out_dir}/state/{batch_id}")

    return (history_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())

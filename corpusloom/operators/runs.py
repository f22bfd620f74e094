"""Run analytics over training histories (H1-H6, H8).

    history(run_id BIGINT, it INT, train_loss DOUBLE, val_loss DOUBLE, secs DOUBLE)
    runs(run_id BIGINT, norm STRING, pos STRING, mlp STRING)

Running minima and counts per run are two-level scans (``functions.scan``)
chunked by ``it``, so one run holding a third of all rows is still spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scan import running_agg

#: evaluation steps per chunk of one run's history
IT_CHUNK = 250 * 1024


def _chunk() -> Column:
    return F.floor(F.col("it") / F.lit(IT_CHUNK))


def improvements(history: DataFrame) -> DataFrame:
    """H1 per row: ``best_before`` (strict running minimum of earlier vals,
    +inf before the first) and ``improved`` = val < best_before.  NaN never
    improves and never becomes the best (NaN sorts above every number)."""
    h = running_agg(history, F.col("val_loss"), ["it"], "best_before", _chunk(),
                    keys=["run_id"], agg="min", inclusive=False)
    prev = F.coalesce(F.col("best_before"), F.lit(float("inf")))
    # a NaN minimum only arises when every earlier val was NaN: treat as +inf
    prev = F.when(F.isnan(prev), F.lit(float("inf"))).otherwise(prev)
    return (h.withColumn("best_before", prev)
            .withColumn("improved", (F.col("val_loss") < prev) & ~F.isnan("val_loss")))


def best_checkpoint(history: DataFrame) -> DataFrame:
    """H1: per run, the kept checkpoint = the last improving eval."""
    imp = improvements(history).filter("improved")
    return imp.groupBy("run_id").agg(
        F.max("it").alias("best_it"),
        F.max_by("val_loss", "it").alias("best_val"))


def evals_since(history: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per row ``best_before``, ``improved`` and ``evals_since``: evals since the last
    improvement (0 on an improving row).

    One scan in two levels.  A chunk of a run is summed up as (rows, minimum,
    place of the first minimum), which merges: a chunk's last improvement is its
    first minimum if that beats all earlier chunks, else it has none.  The rows
    are shuffled once, to their chunk; what earlier chunks carry in comes
    from the table of summaries.  ``state(run_id, best, since)`` continues runs
    whose earlier rows are not in ``history``.
    """
    w = Window.partitionBy("run_id", "__c").orderBy("it")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = (history.withColumn("__c", _chunk())
         .withColumn("__v", F.when(~F.isnan("val_loss"), F.col("val_loss")))
         .withColumn("__r", F.row_number().over(w).cast("bigint"))
         .withColumn("__lm", F.min("__v").over(before)))
    parts = d.groupBy("run_id", "__c").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__m"),
        F.min_by("__r", F.when(F.col("__v").isNotNull(), F.struct("__v", "it"))).alias("__p"))
    if state is None:
        parts = parts.withColumn("__b0", F.lit(float("inf"))).withColumn("__s0", F.lit(0).cast("bigint"))
    else:
        st = state.select("run_id", F.col("best").alias("__b0"), F.col("since").cast("bigint").alias("__s0"))
        parts = (parts.join(st, "run_id", "left").withColumn("__b0", F.coalesce("__b0", F.lit(float("inf"))))
                 .withColumn("__s0", F.coalesce("__s0", F.lit(0).cast("bigint"))))
    earlier = Window.partitionBy("run_id").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.withColumn("__bn", F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("bigint")))
             .withColumn("__bm", F.least("__b0", F.min("__m").over(earlier)))
             .withColumn("__bi", F.max(F.when(F.col("__m") < F.col("__bm"), F.col("__bn") + F.col("__p"))).over(earlier)))
    j = (d.join(parts.select("run_id", "__c", "__bn", "__bm", "__bi", "__s0"), ["run_id", "__c"])
         .withColumn("best_before", F.least("__bm", "__lm"))
         .withColumn("improved", F.coalesce(F.col("__v") < F.col("best_before"), F.lit(False)))
         .withColumn("__r", F.col("__bn") + F.col("__r")))
    last = F.greatest("__bi", F.max(F.when(F.col("improved"), F.col("__r"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return (j.withColumn("__last", last)
            .withColumn("evals_since", F.coalesce(F.col("__r") - F.col("__last"),
                                                  F.col("__r") + F.col("__s0")).cast("int"))
            .drop("__c", "__v", "__r", "__lm", "__bn", "__bm", "__bi", "__s0", "__last"))


def early_stop(history: DataFrame, patience: int, state: DataFrame | None = None) -> DataFrame:
    """H2: drop the rows after the first eval with ``evals_since >= patience``;
    ``patience`` 0 turns it off.  Adds ``stopped`` (true on the stop row)."""
    es = evals_since(history, state)
    if patience <= 0:
        return es.withColumn("stopped", F.lit(False))
    # The first stop of each chunk is found where its rows are; earlier chunks' by chunk.
    here = Window.partitionBy("run_id", "__c").orderBy("it").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("run_id").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    at = F.when(F.col("evals_since") >= patience, F.col("it"))
    d = es.withColumn("__c", _chunk()).withColumn("__first", F.min(at).over(here))
    done = (d.groupBy("run_id", "__c").agg(F.min("__first").alias("__f"))
            .withColumn("__e", F.min("__f").over(earlier)).drop("__f"))
    j = d.join(done, ["run_id", "__c"])
    stop = F.least("__e", "__first")
    return (j.filter(F.coalesce(F.col("it") <= stop, F.lit(True)))
            .withColumn("stopped", F.coalesce(F.col("it") == stop, F.lit(False)))
            .drop("__c", "__first", "__e"))


def run_summary(kept: DataFrame) -> DataFrame:
    """Per run after early stop: iters done, elapsed, last losses, best val."""
    return kept.groupBy("run_id").agg(
        F.max("it").alias("iters"),
        F.max("secs").alias("elapsed"),
        F.max_by("train_loss", "it").alias("final_train"),
        F.max_by("val_loss", "it").alias("final_val"),
        F.min("val_loss").alias("best_val"))


def throughput(summary: DataFrame, batch_size: int, block_size: int) -> DataFrame:
    """H3: iters * batch * block / elapsed seconds (elapsed includes eval time)."""
    tps = F.col("iters") * F.lit(batch_size * block_size) / F.col("elapsed")
    return summary.withColumn("tokens_per_s", F.when(F.col("elapsed") > 0, tps))


def _fmt(fmt: str, *vals: Column) -> Column:
    return F.format_string(fmt, *vals)


def fixed(c: Column | str, d: int) -> Column:
    """Non-negative ``c`` as text with ``d`` decimals, rounded half up by plain
    IEEE arithmetic (``floor(c * 10^d + 0.5)``), so every engine prints the
    same digits; NaN/inf print as ``nan``/``inf``."""
    x = F.col(c) if isinstance(c, str) else c
    scaled = F.floor(x * F.lit(10.0 ** d) + F.lit(0.5)).cast("bigint")
    body = F.concat(F.floor(scaled / F.lit(10 ** d)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((scaled % F.lit(10 ** d)).cast("string"), d, "0"))
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(float("inf")), F.lit("inf"))
            .otherwise(body))


def report_card(summary: DataFrame, runs: DataFrame, batch_size: int, block_size: int) -> DataFrame:
    """H4: one row per run with the report-card figures and its lines."""
    s = throughput(summary, batch_size, block_size).join(runs, "run_id")
    arch = _fmt("- **architecture**: norm=%s, pos=%s, mlp=%s", "norm", "pos", "mlp")
    loss = F.concat(F.lit("- **loss**: final train "), fixed("final_train", 4), F.lit(" / val "),
                    fixed("final_val", 4), F.lit(", best val "), fixed("best_val", 4))
    return s.select("run_id", "norm", "pos", "mlp", "iters",
                    (F.col("elapsed") / 60).alias("minutes"), "final_train", "final_val",
                    "best_val", "tokens_per_s", arch.alias("architecture_line"), loss.alias("loss_line"))


def loss_curve(history: DataFrame) -> DataFrame:
    """H5: long form (run_id, it, series, loss) for any plotter."""
    return history.select("run_id", "it", "train_loss", "val_loss").unpivot(
        ["run_id", "it"], ["train_loss", "val_loss"], "series", "loss"
    ).withColumn("series", F.regexp_replace("series", "_loss$", ""))


def ablation(best: DataFrame, runs: DataFrame, flags: tuple[str, ...] = ("norm", "pos", "mlp")) -> DataFrame:
    """H6: configurations that differ in exactly one flag, with the difference
    of their mean best validation loss.

    Runs are first reduced to one row per configuration (at most 2^3 rows), so
    the self-join compares configurations, never pairs of runs.
    """
    cfg = (best.join(runs, "run_id").groupBy(*flags)
           .agg(F.count(F.lit(1)).alias("runs"), F.avg("best_val").alias("mean_best_val")))
    out = None
    for f in flags:
        others = [g for g in flags if g != f]
        a = cfg.select(*others, F.col(f).alias("a_value"), F.col("runs").alias("a_runs"),
                       F.col("mean_best_val").alias("a_val"))
        b = cfg.select(*others, F.col(f).alias("b_value"), F.col("runs").alias("b_runs"),
                       F.col("mean_best_val").alias("b_val"))
        p = (a.join(b, others).filter(F.col("a_value") < F.col("b_value"))
             .select(F.lit(f).alias("flag"),
                     F.concat_ws(",", *[F.concat(F.lit(g + "="), F.col(g)) for g in others]).alias("fixed"),
                     "a_value", "b_value", "a_runs", "b_runs",
                     (F.col("b_val") - F.col("a_val")).alias("delta")))
        out = p if out is None else out.unionByName(p)
    return out


def progress(history: DataFrame) -> DataFrame:
    """H8: the per-eval progress line with the best mark."""
    imp = improvements(history)
    line = F.concat(_fmt("iter %5d", F.col("it")), F.lit(" | train "), fixed("train_loss", 4),
                    F.lit(" | val "), fixed("val_loss", 4), F.lit(" | "), fixed("secs", 1), F.lit("s"),
                    F.when(F.col("improved"), F.lit("  *best")).otherwise(F.lit("")))
    return imp.select("run_id", "it", "improved", line.alias("line"))

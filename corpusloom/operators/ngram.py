"""Count next-token model (E1-E6): n-gram counts by ``groupBy``, interpolated
with an additive prior, scored by mean cross-entropy in nats.

    p_0(w)    = (n(w)    + a / V)         / (N       + a)
    p_j(w; c) = (n(c, w) + a p_{j-1}(w))  / (n(c)    + a)     j = 1..L

``c`` is the last ``j`` tokens of the context, ``n(w)`` counts training
*targets*, ``n(c) = sum_w n(c, w)``.  Contexts shorter than the model order use
the orders they have.  Counting is the minimiser of the reference's objective
for a table-lookup model; it is a different, weaker model than the
reference's transformer and its losses are not comparable to the ones there.

Tables::

    counts(j INT, ctx ARRAY<T>, tgt T, n BIGINT)          j = 0 has ctx = []
    totals(j INT, ctx ARRAY<T>, nc BIGINT)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expand_orders(df: DataFrame, keep: list) -> DataFrame:
    """One row per order j = 0..size(ctx) with ``ctx`` cut to its last j tokens
    (native explode + slice, no lambda)."""
    e = df.select(*keep, "ctx", F.explode(F.sequence(F.lit(0), F.size("ctx"))).alias("j"))
    L = F.size("ctx")
    return e.select(*[c for c in keep if c != "ctx"], "j",
                    F.slice("ctx", L - F.col("j") + 1, F.col("j")).alias("ctx"))


def fit_counts(train_targets: DataFrame, weight: str | None = None) -> DataFrame:
    """Counts of (context suffix of every order -> next token) over the
    train targets ``(ctx, tgt)``.

    Targets are first reduced to distinct (full context, token) with their
    multiplicity (map-side partial aggregation over the raw rows); the orders
    are expanded only on that small table and summed again.  ``weight`` names
    a multiplicity column when the targets are already aggregated."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    agg = train_targets.groupBy("ctx", "tgt").agg(w.alias("m"))
    ex = _expand_orders(agg, ["tgt", "m"])
    return ex.groupBy("j", "ctx", "tgt").agg(F.sum("m").alias("n"))


def aggregate_targets(targets: DataFrame) -> DataFrame:
    """Distinct (split, ctx, tgt) with multiplicity ``m``: one pass over the
    targets feeds both the fit (train rows) and the scoring (val rows)."""
    return targets.groupBy("split", "ctx", "tgt").agg(F.count(F.lit(1)).alias("m"))


def context_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("j", "ctx").agg(F.sum("n").alias("nc"))


def probabilities(counts: DataFrame, pairs: DataFrame, keys: list[str], vocab_size: int,
                  a: float = 1.0, totals: DataFrame | None = None, order: int | None = None) -> DataFrame:
    """Probability of ``tgt`` after ``ctx`` for each row of ``pairs``;
    returns ``(keys..., p)``.  ``keys`` must identify a row (they may include
    ``ctx`` and ``tgt`` themselves).

    Bottom up: order 0 joins the token counts on ``tgt`` and takes their sum as a
    scalar; order ``j`` joins the counts of the last ``j`` context tokens and
    their total, and mixes in the probability of order ``j - 1``.  No key is
    shared by all rows and no row is expanded to its orders.  A context
    shorter than ``j``, or one never seen, keeps the lower probability.
    ``order`` is the model's highest order (read from ``counts`` if not given).
    """
    if order is None:
        order = int(counts.agg(F.max("j").alias("j")).first()["j"] or 0)
    totals = totals if totals is not None else context_totals(counts)
    kk = [f"__k{i}" for i in range(len(keys))]
    q = pairs.select(*[F.col(k).alias(x) for k, x in zip(keys, kk)], "ctx", "tgt")
    uni = counts.filter(F.col("j") == 0)
    total = F.coalesce(uni.agg(F.sum("n").cast("double").alias("n")).scalar(), F.lit(0.0))
    q = (q.join(uni.select("tgt", "n"), "tgt", "left")
         .withColumn("p", (F.coalesce("n", F.lit(0)).cast("double") + F.lit(a / vocab_size)) / (total + F.lit(a)))
         .drop("n"))
    for j in range(1, order + 1):
        here = counts.filter(F.col("j") == j).select(F.col("ctx").alias("__c"), "tgt", "n")
        tot = totals.filter(F.col("j") == j).select(F.col("ctx").alias("__c"), "nc")
        L = F.size("ctx")
        q = q.withColumn("__c", F.when(L >= j, F.slice("ctx", F.greatest(L - j + 1, F.lit(1)), j)))
        q = (q.join(here, ["__c", "tgt"], "left").join(tot, "__c", "left")
             .withColumn("p", F.when(F.col("nc").isNull(), F.col("p")).otherwise(
                 (F.coalesce("n", F.lit(0)).cast("double") + F.lit(a) * F.col("p"))
                 / (F.col("nc").cast("double") + F.lit(a))))
             .drop("__c", "n", "nc"))
    return q.select(*[F.col(x).alias(k) for k, x in zip(keys, kk)], "p")


def cross_entropy(counts: DataFrame, targets: DataFrame, vocab_size: int, a: float = 1.0,
                  group: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Mean negative log-likelihood (nats per target) of ``targets(ctx, tgt, ...)``.

    Equal (ctx, tgt) pairs are aggregated first, so each distinct pair is
    scored once.  With ``group`` the mean is taken per group (E6).
    """
    group = group or []
    w = F.sum(weight) if weight else F.count(F.lit(1))
    agg = targets.groupBy(*group, "ctx", "tgt").agg(w.alias("m"))
    pk = agg.select("ctx", "tgt").distinct() if group else agg.select("ctx", "tgt")
    scored = probabilities(counts, pk, ["ctx", "tgt"], vocab_size, a)
    j = agg.join(scored, ["ctx", "tgt"])
    return j.groupBy(*group).agg(
        F.sum("m").cast("bigint").alias("targets"),
        (F.sum(F.col("m") * -F.log("p")) / F.sum("m")).alias("ce"))


def next_dist(counts: DataFrame, contexts: DataFrame, vocab: DataFrame, a: float = 1.0,
              key: str = "cid", vocab_size: int | None = None, support: DataFrame | None = None) -> DataFrame:
    """Full next-token distribution for each context row ``(key, ctx)``:
    ``(key, id, token, logit = ln p)``.  The support is generated per row by
    ``explode(sequence(0, V-1))`` (V bounded by the vocabulary), not a join,
    unless ``support`` names the rows ``(key, ctx, id)`` that are wanted."""
    V = vocab_size if vocab_size is not None else vocab.count()
    if support is None:
        support = contexts.select(key, "ctx", F.explode(F.sequence(F.lit(0), F.lit(V - 1))).alias("id"))
    sup = (support.join(F.broadcast(vocab), "id")
           .withColumnRenamed("token", "tgt"))
    pr = probabilities(counts, sup.select(key, "id", "ctx", "tgt"), [key, "id", "tgt"], V, a)
    return pr.select(key, "id", F.col("tgt").alias("token"), F.log("p").alias("logit"))


def window_targets(windows: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Targets of a window table: y[t] with context x[max(0, t-k+1) .. t]
    (a window-trained model never sees context outside its window)."""
    z = windows.select(*keys, "x", F.posexplode(F.col("y")).alias("t", "tgt"))
    lo = F.greatest(F.lit(1), F.col("t") - k + 2)
    ln = F.least(F.lit(k), F.col("t") + 1)
    return z.select(*keys, F.slice("x", lo, ln).alias("ctx"), "tgt")


def loss_history(positioned: DataFrame, n_train: int, n_total: int, vocab_size: int, *, k: int,
                 block: int, batch: int, max_iters: int, eval_interval: int, eval_batches: int,
                 seed: int, a: float = 1.0) -> DataFrame:
    """E5: ``(it, train_loss, val_loss)`` every ``eval_interval`` steps from 0 to
    ``max_iters`` inclusive; the model at step ``it`` has counted the targets
    of the first ``it`` training batches.

    One plan, no loop of jobs: training targets are counted per eval segment
    ``floor(step / eval_interval)``; each eval pair at eval number ``e`` joins
    the segment counts of its (order, context, token) and keeps segments
    ``< e`` (an equi-join plus a filter; at most ``e`` rows per key).
    """
    from corpusloom.operators import sequence as S

    spark = positioned.sparkSession
    n_evals = max_iters // eval_interval + 1
    tr = S.gather_windows(positioned, S.sample_starts(spark, n_train, block, batch, max_iters, seed, "train"), block)
    tt = window_targets(tr, k, ["it"]).withColumn("seg", F.floor(F.col("it") / eval_interval).cast("int"))
    seg = _expand_orders(tt, ["seg", "tgt"]).groupBy("seg", "j", "ctx", "tgt").agg(F.count(F.lit(1)).alias("n"))
    seg_tot = seg.groupBy("seg", "j", "ctx").agg(F.sum("n").alias("nc"))
    parts = []
    for split, length, base in (("train", n_train, 0), ("val", n_total - n_train, n_train)):
        st = S.sample_starts(spark, length, block, batch, n_evals * eval_batches, seed, f"eval-{split}")
        w = S.gather_windows(positioned, st, block, split_base=base)
        parts.append(window_targets(w, k, ["it"]).select(
            F.lit(split).alias("split"), (F.floor(F.col("it") / eval_batches)).cast("int").alias("e"),
            (F.col("it") % eval_batches).alias("b"), "ctx", "tgt"))
    ev = parts[0].unionByName(parts[1])
    m = ev.groupBy("split", "e", "b", "ctx", "tgt").agg(F.count(F.lit(1)).alias("m"))
    keys = m.select("e", "ctx", "tgt").distinct()
    ex = _expand_orders(keys.withColumn("__q", F.col("ctx")), ["e", "__q", "tgt"])
    seen = F.col("seg") < F.col("e")  # segments the model at eval e has counted
    hit = (ex.join(seg, ["j", "ctx", "tgt"], "left")
           .groupBy("e", "__q", "tgt", "j", "ctx")
           .agg(F.sum(F.when(seen, F.col("n")).otherwise(F.lit(0))).alias("n")))
    tot = (ex.select("e", "j", "ctx").distinct().join(seg_tot, ["j", "ctx"], "left")
           .groupBy("e", "j", "ctx").agg(F.sum(F.when(seen, F.col("nc")).otherwise(F.lit(0))).alias("nc")))
    j = hit.join(tot, ["e", "j", "ctx"])
    fold = F.aggregate(
        F.array_sort(F.collect_list(F.struct("j", "n", "nc"))), F.lit(1.0 / vocab_size),
        lambda acc, x: (x["n"].cast("double") + F.lit(a) * acc) / (x["nc"].cast("double") + F.lit(a)))
    probs = j.groupBy("e", "__q", "tgt").agg(fold.alias("p")).withColumnRenamed("__q", "ctx")
    per_batch = (m.join(probs, ["e", "ctx", "tgt"])
                 .groupBy("split", "e", "b").agg((F.sum(F.col("m") * -F.log("p")) / F.sum("m")).alias("l")))
    per_eval = per_batch.groupBy("e").pivot("split", ["train", "val"]).agg(F.avg("l"))
    return per_eval.select((F.col("e") * eval_interval).cast("int").alias("it"),
                           F.col("train").alias("train_loss"), F.col("val").alias("val_loss"))

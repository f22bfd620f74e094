"""Stepwise generation with the count model (F6) and text deltas.

State is one row per prompt ``(prompt_id, toks, new, t, k, n)``: its own
temperature, top-k and number of new tokens (so a micro-batch of requests
with different settings is one job).  Each step crops the context to the last
``order`` tokens (``slice`` with an explicit start, so prompts shorter than
that keep all their tokens), looks up the context's sampling table, draws and
appends; a row stops appending once it has ``n`` new tokens.

The model is fixed while generating, so sampling tables are built once per
(context, t, k): a table with one row per key holding the kept ids/tokens and
their CDF (arrays of at most V entries) is extended each step with unseen
keys (left-anti join), and the state joins it on the key.  Lineage is cut with
reliable checkpoints every few steps.

An order-1 model with the same settings for every prompt has its whole sampling
table up front.  If that table is small (its size is counted), it is broadcast
and each task makes all tokens of its prompts, a step of a batch at a time:
one map-only job however many tokens are asked for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.det import unit
from corpusloom.operators import ngram as E
from corpusloom.operators import sampling as SM
from corpusloom.session import cut_lineage

KEY = ["ctx", "t", "k"]
AT_ONCE = 512  # prompts that a task continues together, whatever the size of an Arrow batch
TABLE_CELLS = 2_000_000  # a sampling table of at most so many cells (16 bytes each) is broadcast


def _unseen(elem) -> object:
    """A token no vocabulary holds: char tokens are single code points, ids are >= 0."""
    return "\u0000<unseen>" if elem.typeName() == "string" else -1


def crop(toks: Column, k: int) -> Column:
    """Last ``min(k, size)`` tokens."""
    n = F.size(toks)
    return F.slice(toks, F.greatest(n - k + 1, F.lit(1)), F.least(F.lit(k), n))


def _candidates(counts: DataFrame, ctxs: DataFrame, vocab: DataFrame, a: float, vocab_size: int, k: int) -> DataFrame:
    """(cid, ctx, id): every token that can be among the ``k`` likeliest (ties too) after an order-1 context.

    Tokens that never follow the context keep the order of the order-0 distribution, so the first
    ``k`` of that and the successors seen are enough, instead of contexts x vocabulary.
    """
    start = ctxs.sparkSession.createDataFrame([(0,)], "cid int").select("cid", F.array().cast(ctxs.schema["ctx"].dataType).alias("ctx"))
    first = SM.top_k(E.next_dist(counts, start, vocab, a, vocab_size=vocab_size), ["cid"], k)
    first = [r["id"] for r in first.select("id").collect()]  # at most the vocabulary
    after = (counts.where("j = 1").select("ctx", F.col("tgt").alias("token")).join(ctxs, "ctx")
             .join(F.broadcast(vocab.select("id", "token")), "token").select("ctx", "id"))
    both = after.unionByName(ctxs.select("ctx", F.explode(F.lit(first).cast(f"array<{dict(vocab.dtypes)['id']}>")).alias("id"))).distinct()
    return both.select(F.col("ctx").alias("cid"), "ctx", "id")


def sampling_tables(counts: DataFrame, need: DataFrame, vocab: DataFrame, a: float,
                    vocab_size: int | None = None, likeliest: int | None = None) -> DataFrame:
    """Per (ctx, t, k): greedy token, and for t > 0 the kept ids/tokens in id
    order with their CDF after temperature and top-k.  ``likeliest``: no row asks
    for more than so many tokens (order-1 contexts only), so no others are scored."""
    ctxs = need.select("ctx").distinct()
    support = _candidates(counts, ctxs, vocab, a, vocab_size, likeliest) if likeliest else None
    d = E.next_dist(counts, ctxs.select(F.col("ctx").alias("cid"), "ctx"), vocab, a,
                    vocab_size=vocab_size, support=support).withColumnRenamed("cid", "ctx")
    best = SM.greedy(d, ["ctx"]).join(F.broadcast(vocab), "id").select("ctx", F.col("token").alias("best"), F.col("id").alias("best_id"))
    dk = d.join(need.filter(F.col("t") > 0), "ctx")
    kept = SM.softmax(SM.top_k(SM.temper(dk, "t"), KEY, "k"), KEY)
    kept = SM.cumulative(kept, KEY)
    arr = kept.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("id", "token", "cum"))).alias("s"))
    arr = arr.select(*KEY, F.col("s.token").alias("kt"), F.col("s.id").alias("ki"), F.col("s.cum").alias("cum"))
    return need.join(best, "ctx").join(arr, KEY, "left")


def _small(table: DataFrame, vocab: DataFrame) -> bool:
    """Whether the padded sampling table stays below ``TABLE_CELLS``."""
    r = table.agg(F.count("*"), F.max(F.size("ki"))).first()
    return (r[0] + vocab.count()) * max(r[1] or 1, 1) <= TABLE_CELLS


def _in_tasks(prompts: DataFrame, table: DataFrame, vocab: DataFrame, steps: int, sampled: bool, seed: int,
              n: str | None) -> DataFrame:
    """All tokens of each prompt from a broadcast order-1 sampling table (see module doc)."""
    spark, elem = prompts.sparkSession, prompts.schema["toks"].dataType.elementType
    ids = vocab.select("id", "token").orderBy("id").collect()
    tokens, place = [r["token"] for r in ids], {r["id"]: i for i, r in enumerate(ids)}
    entries = {r["ctx"][0] if r["ctx"] else None: r for r in table.select("ctx", "best_id", "ki", "cum").collect()}
    unseen = entries[_unseen(elem)]
    rows = [entries.get(t, unseen) for t in tokens] + [unseen, entries[None]]
    wide = max(len(r["ki"] or ()) for r in rows) if sampled else 0
    best = np.array([place[r["best_id"]] for r in rows], np.int64)
    kept, cum = np.zeros((len(rows), wide), np.int64), np.full((len(rows), wide), np.inf)
    last = np.zeros(len(rows), np.int64)
    for i, r in enumerate(rows if sampled else ()):
        m = len(r["ki"])
        kept[i, :m], cum[i, :m], last[i] = [place[x] for x in r["ki"]], r["cum"], m - 1
    bc = spark.sparkContext.broadcast((tokens, best, kept, cum, last))
    arrow = to_arrow_type(elem)

    def run(batches):
        tokens, best, kept, cum, last = bc.value
        slot = {t: i for i, t in enumerate(tokens)}
        for b in (x.slice(i, AT_ONCE) for x in batches for i in range(0, x.num_rows, AT_ONCE)):
            size = pc.fill_null(pc.list_value_length(b.column("toks")), 0).to_numpy()
            ends = b.column("toks").flatten().take(pa.array(np.cumsum(size) - 1, pa.int64(), mask=size == 0)).to_pylist()
            at = np.array([len(tokens) + 1 if t is None else slot.get(t, len(tokens)) for t in ends], np.int64)
            keys, want = b.column("__key").to_pylist(), np.asarray(b.column("__n").to_pylist(), np.int64)
            made = np.zeros((b.num_rows, int(want.max(initial=0))), np.int64)
            for step in range(made.shape[1]):
                if sampled:
                    u = np.array([int(hashlib.md5(f"{k}|{step}".encode()).hexdigest()[:13], 16) for k in keys]) / 2.0 ** 52
                    at = kept[at, np.minimum((cum[at] <= u[:, None]).sum(axis=1), last[at])]
                else:
                    at = best[at]
                made[:, step] = at
            flat = made[np.arange(made.shape[1]) < want[:, None]]
            new = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(want)], pa.int32()),
                                           pa.array(tokens, arrow).take(pa.array(flat)))
            yield pa.RecordBatch.from_arrays([b.column("prompt_id"), b.column("toks"), new], ["prompt_id", "toks", "new_toks"])

    count = F.greatest(F.coalesce(F.col(n).cast("int"), F.lit(0)), F.lit(0)) if n else F.lit(steps)
    kinds = {f.name: f.dataType.simpleString() for f in prompts.schema.fields}
    return (prompts.select("prompt_id", "toks", F.concat_ws("|", F.lit(str(seed)), F.col("prompt_id").cast("string")).alias("__key"),
                           F.least(count, F.lit(steps)).alias("__n"))
            .mapInArrow(run, f"prompt_id {kinds['prompt_id']}, toks {kinds['toks']}, new_toks {kinds['toks']}"))


def generate(prompts: DataFrame, counts: DataFrame, vocab: DataFrame, *, k: int, steps: int,
             temperature: float | str = 1.0, top_k: int | str | None = None, seed: int = 1337,
             a: float = 1.0, n: str | None = None, cut_every: int = 4) -> DataFrame:
    """``prompts(prompt_id, toks, ...)`` -> ``(prompt_id, toks, new_toks)``.

    ``temperature``/``top_k`` are numbers or column names; ``n`` names a
    per-row count of new tokens (default: ``steps`` for every row).
    ``t <= 0`` is greedy (ties to the lowest id); otherwise the draw for step
    ``s`` of prompt ``p`` uses ``u = unit(seed, p, s)``.
    """
    def col(v, typ):
        return F.col(v).cast(typ) if isinstance(v, str) else F.lit(v).cast(typ)

    counts = cut_lineage(counts)
    vocab = cut_lineage(vocab)  # vocabulary-sized; read many times below
    V = vocab.count()
    state = prompts.select(
        "prompt_id", "toks", F.array().cast(prompts.schema["toks"].dataType).alias("new"),
        col(temperature, "double").alias("t"),
        F.coalesce(col(top_k, "int") if top_k is not None else F.lit(None).cast("int"), F.lit(0)).alias("k"),
        (F.col(n).cast("int") if n else F.lit(steps)).alias("n"))
    elem = prompts.schema["toks"].dataType.elementType
    seen = None
    if k == 1:
        # Order-1 contexts the model has seen (at most V rows: broadcast).  Any
        # other one-token context has the same distribution, (0 + a p0)/(0 + a),
        # so it maps to one shared key whose token no vocabulary holds.
        seen = cut_lineage(counts.filter(F.col("j") == 1).select(F.col("ctx").alias("__sc")).distinct())
    table = None
    fixed = seen is not None and not isinstance(temperature, str) and not isinstance(top_k, str)
    if fixed:
        # Same settings for every row: every key is known up front (the seen
        # contexts, the empty context, the shared unseen key), so the whole
        # table is built once, before the first step.
        spark = prompts.sparkSession
        at = prompts.schema["toks"].dataType
        special = spark.createDataFrame([([],), ([_unseen(elem)],)], f"ctx {at.simpleString()}")
        keys = (seen.select(F.col("__sc").alias("ctx")).unionByName(special)
                .withColumn("t", F.lit(float(temperature)).cast("double"))
                .withColumn("k", F.lit(int(top_k or 0)).cast("int")))
        likeliest = 1 if float(temperature) <= 0 else int(top_k or 0)  # 0: the whole vocabulary
        table = cut_lineage(sampling_tables(counts, keys, vocab, a, vocab_size=V, likeliest=likeliest if V else None))
        if V and _small(table, vocab):
            return _in_tasks(prompts, table, vocab, steps, float(temperature) > 0, seed, n)
    for step in range(steps):
        c = crop(F.concat("toks", "new"), k)
        if seen is not None:
            st = state.withColumn("__c", c)
            st = st.join(F.broadcast(seen), st["__c"] == seen["__sc"], "left")
            key = (F.when(F.size("__c") == 0, F.col("__c"))
                   .when(F.col("__sc").isNotNull(), F.col("__c"))
                   .otherwise(F.array(F.lit(_unseen(elem)).cast(elem))))
            state = st.withColumn("ctx", key).drop("__c", "__sc")
        else:
            state = state.withColumn("ctx", c)
        if not fixed:
            need = state.filter(F.size("new") < F.col("n")).select(*KEY).distinct()
            if table is not None:
                need = need.join(table.select(*KEY), KEY, "left_anti")
            if table is None or not need.isEmpty():
                add = sampling_tables(counts, need, vocab, a, vocab_size=V)
                table = cut_lineage(add if table is None else table.unionByName(add))
        j = state.join(table, KEY, "left").withColumn("__u", unit(seed, F.col("prompt_id"), F.lit(step)))
        idx = F.size(F.filter("cum", lambda x: x <= F.col("__u")))
        drawn = F.element_at("kt", F.least(idx + 1, F.size("kt")).cast("int"))
        pick = F.when(F.col("t") > 0, drawn).otherwise(F.col("best"))
        grow = F.size("new") < F.col("n")
        state = j.select("prompt_id", "toks", F.when(grow, F.concat("new", F.array(pick))).otherwise(F.col("new"))
                         .alias("new"), "t", "k", "n")
        if (step + 1) % cut_every == 0 and step + 1 < steps:
            state = cut_lineage(state)
    return state.select("prompt_id", "toks", F.col("new").alias("new_toks"))


def token_deltas(generated: DataFrame, key: str = "prompt_id", new: str = "new_toks") -> DataFrame:
    """F7 for char tokens: each generated token's text is its delta (a char
    token never decodes to nothing), then one ``done`` row per request."""
    d = generated.select(key, F.posexplode(new).alias("step", "delta")).withColumn("done", F.lit(False))
    done = generated.select(key, F.size(new).alias("step"), F.lit(None).cast("string").alias("delta"),
                            F.lit(True).alias("done"))
    return d.unionByName(done)

"""Registered queries: one per operator of the survey's inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables (or tables Spark
derives from them, see ``plans.fixtures``) in whole, and returns a DataFrame
whose columns are cast to BIGINT / DOUBLE (rounded to 6 places) / STRING so
they compare equal with the SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import clean as CL
from corpusloom.operators import bpe as BP
from corpusloom.operators import chars as C
from corpusloom.operators import corpus as B
from corpusloom.operators import ngram as E
from corpusloom.functions.det import unit
from corpusloom.operators import generate as G
from corpusloom.operators import runs as H
from corpusloom.operators import sampling as SM
from corpusloom.operators import sequence as S
from corpusloom.plans import fixtures as X
from corpusloom.session import cut_lineage
from corpusloom.sources.tables import read_table
from corpusloom.streaming.monitor import monitor_batch

# ---------------------------------------------------------------------------
# The reference's defaults (training flags and eval settings).
# ---------------------------------------------------------------------------
BLOCK_SIZE = 64
BATCH_SIZE = 32
EVAL_BATCHES = 20
SEED = 1337
EVAL_INTERVAL = 250
MAX_ITERS = 2000
TRAIN_FRAC = 0.9
# ---------------------------------------------------------------------------
PRIOR = 1.0  # additive prior weight a of the count model


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).cast("double")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def s_(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class CharCorpus:
    """``documents`` in doc_id order, each text followed by a newline, as chars.

    What a query needs of it (vocabulary, lengths, the split cut) is derived from
    the given tables when first asked for, and nothing is kept between queries.
    """

    def __init__(self, docs: DataFrame):
        self.docs = docs
        self.packed = S.pack_chars(docs)
        self.pos = S.global_positions(self.packed)

    @cached_property
    def vocab(self) -> DataFrame:
        return cut_lineage(C.char_vocab(self.docs, terminator="\n"))

    @cached_property
    def V(self) -> int:
        return self.vocab.count()

    @cached_property
    def sizes(self) -> DataFrame:
        return S.doc_sizes(self.packed)

    @cached_property
    def N(self) -> int:
        return int(self.sizes.agg(F.sum("n")).first()[0] or 0)

    @property
    def ntr(self) -> int:
        return S.split_point(self.N, TRAIN_FRAC)

    def targets(self, k: int) -> DataFrame:
        """(split, ctx, tgt, m), one pass over the texts, stored: the fit and the scoring read it."""
        return cut_lineage(S.count_targets(self.packed, k, S.split_cut(self.sizes, self.ntr)))


def char_corpus(spark: SparkSession, sf_dir: str) -> CharCorpus:
    return CharCorpus(X.documents(spark, sf_dir))


def _ctx_str(c: str = "ctx") -> Column:
    return F.array_join(F.col(c), "")


# --------------------------------------------------------------------------- A/B
def q_normalize_newlines(spark, sf_dir):
    d = X.documents(spark, sf_dir)
    t = CL.normalize_newlines(F.col("text"))
    return d.select(big("doc_id").alias("doc_id"), t.alias("text"), big(F.length(t)).alias("n_chars"))


def _raw_step(fn):
    def q(spark, sf_dir):
        r = X.raw(spark, sf_dir)
        return r.select(big("doc_id").alias("doc_id"), fn(F.col("t")).alias("body"))
    return q


q_after_start = _raw_step(CL.after_start)
q_before_end = _raw_step(CL.before_end)
q_drop_credits = _raw_step(CL.drop_credits)
q_drop_notes = _raw_step(CL.drop_notes)
q_strip_ws = _raw_step(CL.strip_ws)
q_strip_boilerplate = _raw_step(CL.strip_boilerplate)


def q_work_report(spark, sf_dir):
    p = X.pieces(spark, sf_dir)
    return B.work_report(p).select(s_("title").alias("title"), big("chars").alias("chars"))


def q_assemble_corpus(spark, sf_dir):
    c = B.assemble_corpus(X.pieces(spark, sf_dir))
    return c.select(big("ord").alias("ord"), big("work_id").alias("work_id"), big("doc_id").alias("doc_id"),
                    big("char_off").alias("char_off"), big(F.length("text")).alias("n_chars"), "text")


# --------------------------------------------------------------------------- C (chars)
def q_char_vocab(spark, sf_dir):
    v = C.char_vocab(X.documents(spark, sf_dir), terminator="\n")
    return v.select(big("id").alias("id"), "token")


def q_char_encode(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    e = C.char_encode(cc.packed, cc.vocab)
    return e.select(big("doc_id").alias("doc_id"), big("pos").alias("pos"), big("id").alias("id"))


def q_char_decode(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    e = C.char_encode(cc.packed, cc.vocab)
    d = C.char_decode(e, cc.vocab)
    return d.select(big("doc_id").alias("doc_id"), "text")


def q_tokenizer_stats(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    per_doc = cc.docs.select(F.length(F.concat("text", F.lit("\n"))).alias("chars"),
                             F.size(F.split(F.concat("text", F.lit("\n")), "", -1)).alias("tokens"))
    st = C.tokenizer_stats(cc.V, per_doc, BLOCK_SIZE, "char")
    return st.select("tokenizer", big("vocab_size").alias("vocab_size"), big("chars").alias("chars"),
                     big("tokens").alias("tokens"), r6("chars_per_token").alias("chars_per_token"),
                     big("context_chars").alias("context_chars"))


def q_vocab_listing(spark, sf_dir):
    v = C.char_vocab(X.documents(spark, sf_dir), terminator="\n")
    return C.vocab_listing(v).select(big("id").alias("id"), "token", "type")


# --------------------------------------------------------------------------- D
def q_global_positions(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    return cc.pos.select(big("doc_id").alias("doc_id"), big("n").alias("n"), big("off").alias("off"))


def q_split_by_position(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    sp = S.split_spans(cc.pos.select("doc_id", "n", "off"), cc.ntr)
    return sp.select(big("doc_id").alias("doc_id"), "split", big("tokens").alias("tokens"),
                     big("first_gpos").alias("first_gpos"), big("last_gpos").alias("last_gpos"))


def _starts(spark, cc: CharCorpus, split: str, steps: int = EVAL_BATCHES, seed: int = SEED):
    n = cc.ntr if split == "train" else cc.N - cc.ntr
    return S.sample_starts(spark, n, BLOCK_SIZE, BATCH_SIZE, steps, seed, split)


def q_sample_starts(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    st = _starts(spark, cc, "train").unionByName(_starts(spark, cc, "val"))
    return st.select("split", big("it").alias("it"), big("row").alias("row"), big("start").alias("start"))


def _windows(spark, cc: CharCorpus, split: str):
    base = 0 if split == "train" else cc.ntr
    return S.gather_windows(cc.pos, _starts(spark, cc, split), BLOCK_SIZE, split_base=base)


def q_gather_windows(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    w = _windows(spark, cc, "train").unionByName(_windows(spark, cc, "val"))
    return w.select("split", big("it").alias("it"), big("row").alias("row"), big("start").alias("start"),
                    F.array_join("x", "").alias("x"), F.array_join("y", "").alias("y"))


def q_next_token(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    p = S.count_targets(cc.packed, 1, S.split_cut(cc.sizes, cc.ntr))
    return p.select("split", F.get("ctx", F.lit(0)).alias("tok"), F.col("tgt").alias("nxt"), big("m").alias("pairs"))


# --------------------------------------------------------------------------- E
def _model(cc: CharCorpus, k: int):
    """Targets aggregated once by (split, ctx, tgt); counts from the train rows, stored as the model's table."""
    agg = cc.targets(k)
    return agg, cut_lineage(E.fit_counts(agg.filter(F.col("split") == "train"), weight="m"))


def q_fit_counts(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 2)
    return counts.select(big("j").alias("j"), _ctx_str().alias("ctx"), F.col("tgt"), big("n").alias("n"))


def q_next_dist(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 1)
    ctxs = cc.vocab.select(F.col("token").alias("cid"), F.array("token").alias("ctx"))
    d = E.next_dist(counts, ctxs, cc.vocab, PRIOR)
    return d.select(F.col("cid").alias("ctx"), big("id").alias("id"), "token", r6("logit").alias("logit"))


def _ce(spark, sf_dir, k):
    cc = char_corpus(spark, sf_dir)
    agg, counts = _model(cc, k)
    ce = E.cross_entropy(counts, agg.filter(F.col("split") == "val"), cc.V, PRIOR, weight="m")
    return ce.select(F.lit("val").alias("split"), big("targets").alias("targets"), r6("ce").alias("ce"))


def q_cross_entropy(spark, sf_dir):
    return _ce(spark, sf_dir, 1)


def q_cross_entropy_k2(spark, sf_dir):
    return _ce(spark, sf_dir, 2)


window_targets = E.window_targets


def q_eval_loss(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 1)
    out = []
    for split in ("train", "val"):
        wt = window_targets(_windows(spark, cc, split), 1, ["it", "row"])
        per_batch = E.cross_entropy(counts, wt, cc.V, PRIOR, group=["it"])
        out.append(per_batch.agg(F.avg("ce").alias("loss")).select(F.lit(split).alias("split"), "loss"))
    res = out[0].unionByName(out[1])
    return res.select("split", r6("loss").alias("loss"))


def q_score_documents(spark, sf_dir):
    """Per benchmark item, mean loss of the char model fitted on documents."""
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 1)
    b = read_table(spark, sf_dir, "benchmark")
    items = S.pack_chars(b.select(F.col("item_id").alias("doc_id"), "text"), terminator=None)
    z = items.select("doc_id", F.col("toks").alias("a"),
                     F.slice("toks", 2, F.greatest(F.size("toks") - 1, F.lit(0))).alias("b"))
    z = z.select("doc_id", F.inline(F.arrays_zip("a", "b"))).filter(F.col("b").isNotNull())
    pairs = z.select("doc_id", F.array("a").alias("ctx"), F.col("b").alias("tgt"))
    ce = E.cross_entropy(counts, pairs, cc.V, PRIOR, group=["doc_id"])
    return ce.select(big("doc_id").alias("item_id"), big("targets").alias("targets"), r6("ce").alias("ce"))


# --------------------------------------------------------------------------- F
TEMPERATURE = 0.8  # the server's default temperature
TOP_K = 40         # the server's default top-k
GEN_STEPS = 300    # the reference's default number of new tokens


def _bigram_dist(spark, sf_dir):
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 1)
    ctxs = cc.vocab.select(F.col("token").alias("cid"), F.array("token").alias("ctx"))
    return E.next_dist(counts, ctxs, cc.vocab, PRIOR)


def q_temper(spark, sf_dir):
    d = SM.temper(_bigram_dist(spark, sf_dir), TEMPERATURE)
    return d.select(F.col("cid").alias("ctx"), big("id").alias("id"), r6("logit").alias("logit"))


def q_top_k(spark, sf_dir):
    d = SM.top_k(SM.temper(_bigram_dist(spark, sf_dir), TEMPERATURE), ["cid"], TOP_K)
    return d.select(F.col("cid").alias("ctx"), big("id").alias("id"), r6("logit").alias("logit"))


def q_softmax(spark, sf_dir):
    d = SM.softmax(SM.top_k(SM.temper(_bigram_dist(spark, sf_dir), TEMPERATURE), ["cid"], TOP_K), ["cid"])
    return d.select(F.col("cid").alias("ctx"), big("id").alias("id"), r6("p").alias("p"))


def q_draw(spark, sf_dir):
    d = SM.softmax(SM.top_k(SM.temper(_bigram_dist(spark, sf_dir), TEMPERATURE), ["cid"], TOP_K), ["cid"])
    r = SM.draw(d, ["cid"], unit(SEED, F.col("cid")))
    return r.select(F.col("cid").alias("ctx"), big("id").alias("id"))


def q_greedy(spark, sf_dir):
    r = SM.greedy(_bigram_dist(spark, sf_dir), ["cid"])
    return r.select(F.col("cid").alias("ctx"), big("id").alias("id"))


def _prompt_toks(spark, sf_dir):
    p = X.prompts(spark, sf_dir)
    toks = F.when(F.length("prompt") == 0, F.array().cast("array<string>")).otherwise(F.split("prompt", "", -1))
    return p.select("prompt_id", toks.alias("toks"))


def _generate(spark, sf_dir, temperature):
    cc = char_corpus(spark, sf_dir)
    _, counts = _model(cc, 1)
    return G.generate(_prompt_toks(spark, sf_dir), counts, cc.vocab, k=1, steps=GEN_STEPS,
                      temperature=temperature, top_k=TOP_K, seed=SEED, a=PRIOR)


def q_generate_greedy(spark, sf_dir):
    g = _generate(spark, sf_dir, 0.0)
    return g.select(big("prompt_id").alias("prompt_id"), F.array_join("new_toks", "").alias("completion"))


def q_generate_sampled(spark, sf_dir):
    g = _generate(spark, sf_dir, TEMPERATURE)
    return g.select(big("prompt_id").alias("prompt_id"), F.array_join("new_toks", "").alias("completion"))


def q_token_deltas(spark, sf_dir):
    d = G.token_deltas(_generate(spark, sf_dir, TEMPERATURE))
    return d.select(big("prompt_id").alias("prompt_id"), big("step").alias("step"), "delta", "done")


def q_normalize_requests(spark, sf_dir):
    r = SM.normalize_requests(X.requests(spark, sf_dir))
    return r.select(big("req_id").alias("req_id"), "prompt", r6("temperature").alias("temperature"),
                    big("top_k").alias("top_k"), big("max_new_tokens").alias("max_new_tokens"), "bad")


# --------------------------------------------------------------------------- H
PATIENCE = 10  # early-stop patience of the published run


def _kept(spark, sf_dir):
    return H.early_stop(X.history(spark, sf_dir), PATIENCE)


def q_best_checkpoint(spark, sf_dir):
    b = H.best_checkpoint(X.history(spark, sf_dir))
    return b.select(big("run_id").alias("run_id"), big("best_it").alias("best_it"), r6("best_val").alias("best_val"))


def q_early_stop(spark, sf_dir):
    k = _kept(spark, sf_dir)
    return k.select(big("run_id").alias("run_id"), big("it").alias("it"), r6("train_loss").alias("train_loss"),
                    r6("val_loss").alias("val_loss"), big("evals_since").alias("evals_since"), "stopped")


def q_monitor(spark, sf_dir):
    """H7 in its batch form over the whole history (the stream's tables hold the same rows)."""
    m = monitor_batch(X.history(spark, sf_dir), PATIENCE)
    return m.select(big("run_id").alias("run_id"), big("it").alias("it"), r6("val_loss").alias("val_loss"),
                    "improved", big("evals_since").alias("evals_since"), "stopped")


def q_throughput(spark, sf_dir):
    t = H.throughput(H.run_summary(_kept(spark, sf_dir)), BATCH_SIZE, BLOCK_SIZE)
    return t.select(big("run_id").alias("run_id"), big("iters").alias("iters"), r6("elapsed").alias("elapsed"),
                    r6("tokens_per_s").alias("tokens_per_s"))


def q_report_card(spark, sf_dir):
    r = H.report_card(H.run_summary(_kept(spark, sf_dir)), X.runs(spark, sf_dir), BATCH_SIZE, BLOCK_SIZE)
    return r.select(big("run_id").alias("run_id"), "norm", "pos", "mlp", big("iters").alias("iters"),
                    r6("minutes").alias("minutes"), r6("final_train").alias("final_train"),
                    r6("final_val").alias("final_val"), r6("best_val").alias("best_val"),
                    r6("tokens_per_s").alias("tokens_per_s"), "architecture_line", "loss_line")


def q_loss_curve(spark, sf_dir):
    c = H.loss_curve(X.history(spark, sf_dir))
    return c.select(big("run_id").alias("run_id"), big("it").alias("it"), "series", r6("loss").alias("loss"))


def q_ablation(spark, sf_dir):
    a = H.ablation(H.best_checkpoint(X.history(spark, sf_dir)), X.runs(spark, sf_dir))
    return a.select("flag", "fixed", "a_value", "b_value", big("a_runs").alias("a_runs"),
                    big("b_runs").alias("b_runs"), r6("delta").alias("delta"))


def q_progress(spark, sf_dir):
    p = H.progress(X.history(spark, sf_dir))
    return p.select(big("run_id").alias("run_id"), big("it").alias("it"), "improved", "line")


# --------------------------------------------------------------------------- C (BPE), A4/A5
BPE_VOCAB = 2048  # the reference's default vocabulary
_BPE_FITS: dict = {}


def _corpus_texts(spark, sf_dir):
    """``documents`` in order, each text followed by a newline."""
    d = X.documents(spark, sf_dir)
    return d.select("doc_id", F.concat("text", F.lit("\n")).alias("text"))


def bpe_codec(spark, sf_dir, vocab_size: int = BPE_VOCAB) -> BP.Codec:
    """Fit once per (session, input, size); the fitted codec is vocabulary-sized."""
    key = (spark.sparkContext.applicationId, sf_dir, vocab_size)
    if key not in _BPE_FITS:
        vocab, merges, _ = BP.fit_bpe(BP.piece_counts(_corpus_texts(spark, sf_dir)), vocab_size)
        _BPE_FITS[key] = BP.Codec.from_frames(vocab, merges)
    return _BPE_FITS[key]


def q_pretokenize(spark, sf_dir):
    d = _corpus_texts(spark, sf_dir)
    e = d.select("doc_id", F.posexplode(BP.pretokenize(F.col("text"))).alias("pos", "piece"))
    return e.select(big("doc_id").alias("doc_id"), big("pos").alias("pos"), "piece")


def q_piece_counts(spark, sf_dir):
    pc = BP.piece_counts(_corpus_texts(spark, sf_dir))
    return pc.select("piece", big("n").alias("n"))


def q_pair_counts(spark, sf_dir):
    """C7 at character level: adjacent characters inside pieces, weighted by
    piece count (the same pair-count operator the BPE fit runs each round)."""
    pc = BP.piece_counts(_corpus_texts(spark, sf_dir))
    chars = pc.select(F.split("piece", "", -1).alias("cs"), "n")
    vocab = C.char_vocab(chars.select(F.array_join("cs", "").alias("t")), "t")
    long = chars.select("n", F.posexplode("cs").alias("pos", "token"), F.col("cs").alias("key"))
    ids = long.join(F.broadcast(vocab), "token")
    packed = ids.groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("s"))
    pairs = BP.pair_counts(packed.select(F.col("s.id").alias("ids"), "n"))
    va = vocab.select(F.col("id").alias("a"), F.col("token").alias("left"))
    vb = vocab.select(F.col("id").alias("b"), F.col("token").alias("right"))
    return pairs.join(F.broadcast(va), "a").join(F.broadcast(vb), "b").select("left", "right", big("c").alias("n"))


def q_bpe_vocab(spark, sf_dir):
    codec = bpe_codec(spark, sf_dir)
    v = BP.vocab_frame(spark, codec.tokens)
    return C.vocab_listing(v).select(big("id").alias("id"), "token", "type")


def q_bpe_merges(spark, sf_dir):
    codec = bpe_codec(spark, sf_dir)
    m = spark.createDataFrame([(r, a, b) for r, (a, b) in enumerate(codec.merges)],
                              "rank int, left string, right string")
    return C.merge_listing(m).select(big("rank").alias("rank"), "merge")


def q_bpe_encode(spark, sf_dir):
    codec = bpe_codec(spark, sf_dir)
    e = BP.bpe_encode(_corpus_texts(spark, sf_dir), codec)
    return e.select(big("doc_id").alias("doc_id"), big(F.size("ids")).alias("tokens"),
                    F.array_join("ids", " ").alias("ids"))


def q_bpe_decode(spark, sf_dir):
    codec = bpe_codec(spark, sf_dir)
    e = BP.bpe_encode(_corpus_texts(spark, sf_dir), codec)
    return BP.bpe_decode(e.select("doc_id", "ids"), codec).select(big("doc_id").alias("doc_id"), "text")


def q_bpe_stats(spark, sf_dir):
    codec = bpe_codec(spark, sf_dir)
    d = _corpus_texts(spark, sf_dir)
    e = BP.bpe_encode(d, codec).select(F.length("text").alias("chars"), F.size("ids").alias("tokens"))
    st = C.tokenizer_stats(len(codec.tokens), e, BLOCK_SIZE, "bpe")
    return st.select("tokenizer", big("vocab_size").alias("vocab_size"), big("chars").alias("chars"),
                     big("tokens").alias("tokens"), r6("chars_per_token").alias("chars_per_token"),
                     big("context_chars").alias("context_chars"))


def _id_model(ids: DataFrame):
    """Bigram targets and counts of packed token ids, encoded once and stored."""
    ids = cut_lineage(ids)
    sizes = S.doc_sizes(ids)
    n = int(sizes.agg(F.sum("n")).first()[0] or 0)
    agg = cut_lineage(S.count_targets(ids, 1, S.split_cut(sizes, S.split_point(n, TRAIN_FRAC))))
    return agg, cut_lineage(E.fit_counts(agg.filter(F.col("split") == "train"), weight="m"))


def q_cross_entropy_bpe(spark, sf_dir):
    """E3 on BPE ids: the count model over byte-level BPE tokens."""
    codec = bpe_codec(spark, sf_dir)
    e = BP.bpe_encode(_corpus_texts(spark, sf_dir), codec).select("doc_id", F.col("ids").alias("toks"))
    agg, counts = _id_model(e)
    ce = E.cross_entropy(counts, agg.filter(F.col("split") == "val"), len(codec.tokens), PRIOR, weight="m")
    return ce.select(F.lit("val").alias("split"), big("targets").alias("targets"), r6("ce").alias("ce"))


def _all_tables(spark, sf_dir):
    from corpusloom.sources.tables import TABLES
    return {t: read_table(spark, sf_dir, t) for t in TABLES}


def q_release_manifest(spark, sf_dir):
    from corpusloom.sources.artifacts import release_manifest, table_manifest
    m = table_manifest(spark, _all_tables(spark, sf_dir))
    return release_manifest(spark, m, list(_all_tables(spark, sf_dir))).select("name", big("rows").alias("rows"))


def q_release_files(spark, sf_dir):
    """A5 over what the folder holds: its files give the manifest, the release list what has to be there."""
    from corpusloom.sources.artifacts import file_manifest, release_manifest, table_manifest
    from corpusloom.sources.tables import TABLES
    files = file_manifest(spark, sf_dir, "*.parquet").withColumn("name", F.regexp_replace("name", r"\.parquet$", ""))
    listed = {r["name"]: read_table(spark, sf_dir, r["name"]) for r in files.select("name").distinct().collect()}
    m = release_manifest(spark, files.join(table_manifest(spark, listed), "name"), list(TABLES))
    return m.select("name", big("rows").alias("rows"), big("bytes").alias("bytes"),
                    big("checksum").alias("checksum"))


def q_loss_history(spark, sf_dir):
    """E5 with the reference's schedule (eval every 250 of 2,000 steps, 20
    eval batches of 32 x 64) for the char count model."""
    cc = char_corpus(spark, sf_dir)
    h = E.loss_history(cc.pos, cc.ntr, cc.N, cc.V, k=1, block=BLOCK_SIZE, batch=BATCH_SIZE,
                       max_iters=MAX_ITERS, eval_interval=EVAL_INTERVAL, eval_batches=EVAL_BATCHES,
                       seed=SEED, a=PRIOR)
    return h.select(big("it").alias("it"), r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


def q_bpe_token_deltas(spark, sf_dir):
    """F6 + F7 on BPE ids: the count model over BPE tokens continues each user
    prompt (sampled), and the ids are turned into text deltas."""
    codec = bpe_codec(spark, sf_dir)
    e = BP.bpe_encode(_corpus_texts(spark, sf_dir), codec).select("doc_id", F.col("ids").alias("toks"))
    _, counts = _id_model(e)
    vocab = spark.range(len(codec.tokens)).select(F.col("id").cast("int").alias("id"),
                                                  F.col("id").cast("int").alias("token"))
    p = BP.bpe_encode(X.prompts(spark, sf_dir).withColumnRenamed("prompt", "text"), codec)
    g = G.generate(p.select("prompt_id", F.col("ids").alias("toks")), counts, vocab, k=1, steps=GEN_STEPS,
                   temperature=TEMPERATURE, top_k=TOP_K, seed=SEED, a=PRIOR)
    d = BP.bpe_token_deltas(g.select("prompt_id", F.col("new_toks").alias("new_ids")), codec)
    return d.select(big("prompt_id").alias("prompt_id"), big("step").alias("step"), "delta", "done")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_newlines": q_normalize_newlines,
    "after_start": q_after_start,
    "before_end": q_before_end,
    "drop_credits": q_drop_credits,
    "drop_notes": q_drop_notes,
    "strip_ws": q_strip_ws,
    "strip_boilerplate": q_strip_boilerplate,
    "work_report": q_work_report,
    "assemble_corpus": q_assemble_corpus,
    "char_vocab": q_char_vocab,
    "char_encode": q_char_encode,
    "char_decode": q_char_decode,
    "tokenizer_stats": q_tokenizer_stats,
    "vocab_listing": q_vocab_listing,
    "global_positions": q_global_positions,
    "split_by_position": q_split_by_position,
    "sample_starts": q_sample_starts,
    "gather_windows": q_gather_windows,
    "next_token": q_next_token,
    "fit_counts": q_fit_counts,
    "next_dist": q_next_dist,
    "cross_entropy": q_cross_entropy,
    "cross_entropy_k2": q_cross_entropy_k2,
    "eval_loss": q_eval_loss,
    "score_documents": q_score_documents,
    "loss_history": q_loss_history,
    "temper": q_temper,
    "top_k": q_top_k,
    "softmax": q_softmax,
    "draw": q_draw,
    "greedy": q_greedy,
    "generate_greedy": q_generate_greedy,
    "generate_sampled": q_generate_sampled,
    "token_deltas": q_token_deltas,
    "bpe_token_deltas": q_bpe_token_deltas,
    "normalize_requests": q_normalize_requests,
    "best_checkpoint": q_best_checkpoint,
    "early_stop": q_early_stop,
    "monitor": q_monitor,
    "throughput": q_throughput,
    "report_card": q_report_card,
    "loss_curve": q_loss_curve,
    "ablation": q_ablation,
    "progress": q_progress,
    "pretokenize": q_pretokenize,
    "piece_counts": q_piece_counts,
    "pair_counts": q_pair_counts,
    "bpe_fit": q_bpe_vocab,
    "bpe_merges": q_bpe_merges,
    "bpe_encode": q_bpe_encode,
    "bpe_decode": q_bpe_decode,
    "bpe_stats": q_bpe_stats,
    "cross_entropy_bpe": q_cross_entropy_bpe,
    "release_manifest": q_release_manifest,
    "release_files": q_release_files,
}

"""greedy generation equals a plain loop over the count model; short
prompts keep their context; the stream equals the batch."""
import json
import os
from collections import Counter


from corpusloom.operators import generate as G
from corpusloom.operators import ngram as E
from corpusloom.operators import sequence as S
from corpusloom.streaming.generate_stream import complete_requests, generate_stream

TEXTS = ["abcab", "cabbage", "bad cab", "abba"]


def _model(spark, k):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    packed = S.pack_chars(df)
    seq = "".join(t + "\n" for t in TEXTS)
    tg = S.targets(S.global_positions(packed), k, len(seq))  # all train
    counts = E.fit_counts(tg.select("ctx", "tgt"))
    chars = sorted(set(seq))
    vocab = spark.createDataFrame(list(enumerate(chars)), "id int, token string")
    return seq, chars, counts, vocab


def _greedy_loop(seq, chars, k, prompt, n, a=1.0):
    V = len(chars)
    cnt = Counter()
    for g in range(1, len(seq)):
        c = seq[max(0, g - k):g]
        for j in range(len(c) + 1):
            cnt[(c[len(c) - j:], seq[g])] += 1
    tot = Counter()
    for (c, w), m in cnt.items():
        tot[c] += m
    out = prompt
    for _ in range(n):
        c = out[-k:] if k else ""
        best, bp = None, -1.0
        for w in chars:
            p = 1.0 / V
            for j in range(len(c) + 1):
                cj = c[len(c) - j:]
                p = (cnt[(cj, w)] + a * p) / (tot[cj] + a)
            if p > bp + 1e-15:
                best, bp = w, p
        out += best
    return out[len(prompt):]


def test_greedy_equals_loop_and_short_prompts(spark):
    for k in (1, 2):
        seq, chars, counts, vocab = _model(spark, k)
        prompts = spark.createDataFrame([(1, list("ab")), (2, list("c")), (3, []), (4, list("zq"))],
                                        "prompt_id long, toks array<string>")
        g = {r["prompt_id"]: "".join(r["new_toks"]) for r in
             G.generate(prompts, counts, vocab, k=k, steps=5, temperature=0.0).collect()}
        for pid, p in [(1, "ab"), (2, "c"), (3, ""), (4, "zq")]:
            assert g[pid] == _greedy_loop(seq, chars, k, p, 5), (k, pid)


def test_sampled_is_deterministic_and_deltas(spark):
    seq, chars, counts, vocab = _model(spark, 1)
    prompts = spark.createDataFrame([(1, list("ab")), (2, list("c"))], "prompt_id long, toks array<string>")
    a = G.generate(prompts, counts, vocab, k=1, steps=4, temperature=0.8, top_k=2, seed=5)
    b = G.generate(prompts.repartition(3), counts, vocab, k=1, steps=4, temperature=0.8, top_k=2, seed=5)
    ra = sorted((r["prompt_id"], tuple(r["new_toks"])) for r in a.collect())
    assert ra == sorted((r["prompt_id"], tuple(r["new_toks"])) for r in b.collect())
    d = G.token_deltas(a).collect()
    assert len(d) == 2 * 4 + 2 and sum(r["done"] for r in d) == 2


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmpdir_path):
    seq, chars, counts, vocab = _model(spark, 1)
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    reqs = [{"req_id": 1, "body": json.dumps({"prompt": "ab", "temperature": 0, "max_new_tokens": 3})},
            {"req_id": 2, "body": ""},
            {"req_id": 3, "body": json.dumps({"prompt": "c", "top_k": 99, "max_new_tokens": 2})},
            {"req_id": 4, "body": json.dumps({"temperature": None})}]
    for i, part in enumerate([reqs[:2], reqs[2:]]):
        with open(os.path.join(src, f"part{i}.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in part))
    # the stream generates each request up to its own length; req 2 asks 240
    small = [dict(r) for r in reqs]
    small[1]["body"] = json.dumps({"max_new_tokens": 2})
    for i, part in enumerate([small[:2], small[2:]]):
        with open(os.path.join(src, f"part{i}.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in part))
    out = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")
    q = generate_stream(spark, src, out, ck, counts, vocab)
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(out, "completions"))
    bad = spark.read.parquet(os.path.join(out, "bad"))
    batch_in = spark.createDataFrame([(r["req_id"], r["body"]) for r in small], "req_id long, body string")
    done, bad_b = complete_requests(batch_in, counts, vocab)
    assert sorted((r["req_id"], r["completion"]) for r in streamed.collect()) == \
        sorted((r["req_id"], r["completion"]) for r in done.collect())
    assert [r["req_id"] for r in bad.collect()] == [4] == [r["req_id"] for r in bad_b.collect()]
    n = streamed.count()
    q2 = generate_stream(spark, src, out, ck, counts, vocab)
    q2.awaitTermination(300)
    assert spark.read.parquet(os.path.join(out, "completions")).count() == n


def test_tasks_and_joins_generate_the_same(spark, monkeypatch):
    """The broadcast sampling table and the stepwise joins give the same tokens: empty, unseen and repeated prompts."""
    seq, chars, counts, vocab = _model(spark, 1)
    prompts = spark.createDataFrame([(1, list("ab"), 9), (2, [], 7), (3, ["z"], 0), (3, ["z"], 4), (None, list("c"), 5)],
                                    "prompt_id long, toks array<string>, n int")
    for t, k in ((0.0, None), (0.8, 3)):
        got = []
        for cells in (G.TABLE_CELLS, 0):
            monkeypatch.setattr(G, "TABLE_CELLS", cells)
            out = G.generate(prompts, counts, vocab, k=1, steps=5, temperature=t, top_k=k, seed=3, n="n")
            got.append(sorted((r["prompt_id"] or 0, "".join(r["toks"]), "".join(r["new_toks"])) for r in out.collect()))
            monkeypatch.undo()
        assert got[0] == got[1] and len(got[0]) == 5


def test_candidates_hold_the_likeliest(spark):
    """Sampling tables from the candidates equal those from the whole vocabulary."""
    seq, chars, counts, vocab = _model(spark, 1)
    keys = spark.createDataFrame([([c], 0.8, 3) for c in chars] + [([], 0.8, 3), (["?"], 0.8, 3)], "ctx array<string>, t double, k int")
    got = [sorted(map(repr, G.sampling_tables(counts, keys, vocab, 1.0, vocab_size=len(chars), likeliest=k).collect()))
           for k in (3, None)]
    assert got[0] == got[1] and len(got[0]) == len(chars) + 2


def test_tasks_continue_few_prompts_at_a_time(spark, monkeypatch):
    from pyspark.sql import functions as F

    from corpusloom.operators import generate as G
    from corpusloom.operators import ngram as E
    rows = [([], "a", 3), ([], "b", 2), ([], "c", 1), (["a"], "b", 2), (["b"], "a", 1), (["b"], "c", 1)]
    counts = E.fit_counts(spark.createDataFrame(rows, "ctx array<string>, tgt string, m long").where("size(ctx) = 1"), weight="m")
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id int, token string")
    toks = [None, [], ["a"], ["c", "b"], ["z"]]
    prompts = spark.createDataFrame([(i, toks[i % 5]) for i in range(50)], "prompt_id long, toks array<string>").coalesce(1)

    def made():
        g = G.generate(prompts, counts, vocab, k=1, steps=6, temperature=0.8, top_k=2, seed=3)
        return {r["prompt_id"]: (r["toks"], r["new_toks"]) for r in g.collect()}

    together = made()
    assert len(together) == 50 and all(len(n) == 6 for _, n in together.values()) and together[3][0] == ["c", "b"]
    monkeypatch.setattr(G, "AT_ONCE", 7)
    assert made() == together

"""D1-D5 and E1-E3 against a plain-Python pass over the concatenated sequence."""
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ngram as E
from corpusloom.operators import sequence as S

TEXTS = ["abcab", "", "ba", "c", "abcabcab", "aa", "cabbage"]


def _corpus(spark, width):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    packed = S.pack_chars(df)
    seq = "".join(t + "\n" for t in TEXTS)
    return packed, S.global_positions(packed, width=width), seq


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_positions_and_pairs(spark, width):
    packed, pos, seq = _corpus(spark, width)
    N = S.total_tokens(packed)
    assert N == len(seq)
    ntr = S.split_point(N)
    assert ntr == int(0.9 * N)
    long = S.explode_positions(pos).orderBy("gpos").collect()
    assert "".join(r["tok"] for r in long) == seq
    assert [r["gpos"] for r in long] == list(range(N))
    got = Counter((r["split"], r["tok"], r["nxt"]) for r in S.next_token(pos, ntr, width=width).collect())
    want = Counter()
    for i in range(N - 1):
        if i + 1 < ntr:
            want[("train", seq[i], seq[i + 1])] += 1
        elif i >= ntr:
            want[("val", seq[i], seq[i + 1])] += 1
    assert got == want


@pytest.mark.parametrize("k,width", [(1, 2), (2, 1), (3, 1000)])
def test_targets_and_cross_entropy(spark, k, width):
    packed, pos, seq = _corpus(spark, width)
    N = len(seq)
    ntr = S.split_point(N)
    tg = S.targets(pos, k, ntr, width=width)
    got = sorted((r["split"], r["gpos"], "".join(r["ctx"]), r["tgt"]) for r in tg.collect())
    want = []
    for g in range(N):
        start = 0 if g < ntr else ntr
        L = min(k, g - start)
        if L > 0:
            want.append(("train" if g < ntr else "val", g, seq[g - L:g], seq[g]))
    assert got == sorted(want)
    V = len(set(seq))
    a = 0.5
    counts = E.fit_counts(tg.filter("split = 'train'").select("ctx", "tgt"))
    ce = E.cross_entropy(counts, tg.filter("split = 'val'").select("ctx", "tgt"), V, a).first()
    # brute force interpolated model
    tr = [w for w in want if w[0] == "train"]
    cnt = Counter()
    for _, _, c, w in tr:
        for j in range(0, len(c) + 1):
            cnt[(c[len(c) - j:], w)] += 1
    tot = Counter()
    for (c, w), n in cnt.items():
        tot[c] += n

    def p(c, w):
        pr = 1.0 / V
        for j in range(0, len(c) + 1):
            cj = c[len(c) - j:]
            pr = (cnt[(cj, w)] + a * pr) / (tot[cj] + a)
        return pr
    va = [w for w in want if w[0] == "val"]
    exp = sum(-math.log(p(c, w)) for _, _, c, w in va) / len(va)
    assert ce["targets"] == len(va)
    assert ce["ce"] == pytest.approx(exp, rel=1e-12)


def test_next_dist_sums_to_one(spark):
    packed, pos, seq = _corpus(spark, 3)
    ntr = S.split_point(len(seq))
    tg = S.targets(pos, 2, ntr)
    counts = E.fit_counts(tg.filter("split = 'train'").select("ctx", "tgt"))
    vocab = spark.createDataFrame(list(enumerate(sorted(set(seq)))), "id int, token string")
    ctx = spark.createDataFrame([(0, ["a", "b"]), (1, ["z"]), (2, [])], "cid int, ctx array<string>")
    d = E.next_dist(counts, ctx, vocab).groupBy("cid").agg(F.sum(F.exp("logit")).alias("s")).collect()
    assert len(d) == 3 and all(abs(r["s"] - 1) < 1e-12 for r in d)


def test_windows(spark):
    packed, pos, seq = _corpus(spark, 2)
    ntr = S.split_point(len(seq))
    block = 4
    st = S.sample_starts(spark, ntr, block, batch=5, steps=3, seed=7, split="train")
    w = S.gather_windows(pos, st, block).collect()
    assert len(w) == 15
    for r in w:
        s = r["start"]
        assert 0 <= s < ntr - block
        assert "".join(r["x"]) == seq[s:s + block]
        assert "".join(r["y"]) == seq[s + 1:s + 1 + block]
    base = ntr
    sv = S.sample_starts(spark, len(seq) - ntr, 2, batch=3, steps=1, seed=7, split="val")
    for r in S.gather_windows(pos, sv, 2, split_base=base).collect():
        assert "".join(r["x"]) == seq[base + r["start"]:base + r["start"] + 2]
    with pytest.raises(ValueError):
        S.sample_starts(spark, 4, 4, 1, 1, 1, "val")


def test_partitioning_does_not_change_results(spark):
    packed, pos, seq = _corpus(spark, 2)
    ntr = S.split_point(len(seq))
    res = set()
    for parts in (1, 3, 16):
        p2 = S.global_positions(packed.repartition(parts), width=2)
        tg = S.targets(p2, 2, ntr, width=2)
        counts = E.fit_counts(tg.filter("split = 'train'").select("ctx", "tgt"))
        res.add(round(E.cross_entropy(counts, tg.filter("split = 'val'").select("ctx", "tgt"), 4).first()["ce"], 12))
    assert len(res) == 1


def test_split_cut_on_any_ids(spark):
    """Every cut of a sequence whose documents have random 64-bit ids, the extremes among them."""
    rnd = random.Random(5)
    ids = sorted({-(1 << 63), (1 << 63) - 1, -1, 0, 1, *(rnd.randrange(-(1 << 63), 1 << 63) for _ in range(6))})
    sizes = [(i, rnd.randrange(1, 4)) for i in ids]
    df = spark.createDataFrame(sizes, "doc_id long, n long")
    flat = [(i, o) for i, n in sizes for o in range(n)]
    for g in (0, 1, len(flat) // 2, len(flat) - 1):
        assert S.split_cut(df, g, fan=64) == flat[g]
    assert S.split_cut(df, len(flat)) is None
    assert S.split_cut(df.filter("n > 9"), 0) is None


@pytest.mark.parametrize("k,width", [(1, 1), (6, 2)])
def test_count_targets_equals_targets(spark, k, width):
    """Map-only counts and the table of heads and tails against the row-level targets, at every kind of cut."""
    packed, pos, seq = _corpus(spark, width)
    sizes = S.doc_sizes(packed)
    for ntr in (6, 7, len(seq)):
        want = {}
        for g in range(len(seq)):
            split = "train" if g < ntr else "val"
            L = min(k, g - (0 if g < ntr else ntr))
            if L > 0:
                key = (split, seq[g - L:g], seq[g])
                want[key] = want.get(key, 0) + 1
        rows = S.count_targets(packed, k, S.split_cut(sizes, ntr), width=width).collect()
        assert {(r["split"], "".join(r["ctx"]), r["tgt"]): r["m"] for r in rows} == want
        assert len(rows) == len(want)


def test_null_texts_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "")], "doc_id long, text string")
    rows = S.global_positions(S.pack_chars(df)).select("doc_id", "n", "off").orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, 3, 0), (2, 1, 3), (3, 1, 4)]
    none = S.pack_chars(df.filter("doc_id > 9"))
    assert S.count_targets(none, 2, S.split_cut(S.doc_sizes(none), 0)).count() == 0


def test_split_spans(spark):
    packed, pos, seq = _corpus(spark, 2)
    for ntr in (0, 7):
        long = S.split_by_position(pos, ntr).groupBy("doc_id", "split").agg(
            F.count(F.lit(1)).alias("tokens"), F.min("gpos").alias("a"), F.max("gpos").alias("b"))
        want = {tuple(r) for r in long.select("doc_id", "split", "tokens", "a", "b").collect()}
        assert {tuple(r) for r in S.split_spans(pos.select("doc_id", "n", "off"), ntr).collect()} == want

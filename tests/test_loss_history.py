"""E5 against a brute-force replay: the same keyed window draws, counts of the
first ``it`` training batches, interpolated probabilities, mean of batch means."""
import hashlib
import math
from collections import Counter

import pytest

from corpusloom.operators import ngram as E
from corpusloom.operators import sequence as S

TEXTS = ["abcab", "cabbage", "bad cab", "abba", "a cab", "baggage"]


def _h60(*k):
    return int(hashlib.md5("|".join(str(x) for x in k).encode()).hexdigest()[:15], 16)


def test_loss_history_equals_replay(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    packed = S.pack_chars(df)
    seq = "".join(t + "\n" for t in TEXTS)
    N = len(seq)
    ntr = S.split_point(N)
    V = len(set(seq))
    k, block, batch, iters, every, evb, seed, a = 1, 3, 2, 4, 2, 2, 9, 1.0
    got = {r["it"]: (r["train_loss"], r["val_loss"]) for r in E.loss_history(
        S.global_positions(packed, width=2), ntr, N, V, k=k, block=block, batch=batch, max_iters=iters,
        eval_interval=every, eval_batches=evb, seed=seed, a=a).collect()}

    def windows(split, length, base, it):
        return [base + _h60(seed, split, it, r) % (length - block) for r in range(batch)]

    def pairs(s):
        return [(seq[s + t], seq[s + t + 1]) for t in range(block)]  # k = 1: context x[t]

    want = {}
    for e in range(iters // every + 1):
        step = e * every
        cnt, uni = Counter(), Counter()
        for it in range(step):
            for s in windows("train", ntr, 0, it):
                for c, w in pairs(s):
                    cnt[(c, w)] += 1
                    uni[w] += 1
        tot = Counter()
        for (c, w), n in cnt.items():
            tot[c] += n
        n0 = sum(uni.values())

        def p(c, w):
            p0 = (uni[w] + a / V) / (n0 + a)
            return (cnt[(c, w)] + a * p0) / (tot[c] + a)
        res = []
        for split, length, base in (("train", ntr, 0), ("val", N - ntr, ntr)):
            means = []
            for b in range(evb):
                ps = [p(c, w) for s in windows(f"eval-{split}", length, base, e * evb + b) for c, w in pairs(s)]
                means.append(sum(-math.log(x) for x in ps) / len(ps))
            res.append(sum(means) / len(means))
        want[step] = tuple(res)
    assert set(got) == set(want)
    for it in want:
        assert got[it][0] == pytest.approx(want[it][0], rel=1e-12)
        assert got[it][1] == pytest.approx(want[it][1], rel=1e-12)
    assert got[0][0] == pytest.approx(math.log(V))

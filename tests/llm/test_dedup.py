"""Exact, near and substring deduplication against brute force."""
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup as X
from corpusloom.llm import ngram_join as J
from corpusloom.llm import suffix_dedup as S
from corpusloom.llm.components import components

WS = re.compile("[\x20\x09-\x0d]")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(WS.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    return {k: (min(v)[2], len(v)) for k, v in groups.items()}


def test_exact_with_nulls_ties_and_weak_hash(make_docs):
    rows = [(1, "a b", "en", "s"), (2, "a  b", "en", "s"), (3, "ab", None, None), (4, None, None, None), (5, "", "x", "y"),
            (6, " \t", "x", "y"), (7, "c", "x", "y"), (7, "c", "x", "y"), (8, " c", "x", "y")]
    want = brute_exact([r[:2] for r in rows])
    for weak in (F.md5, lambda c: F.substring(F.md5(c), 1, 1)):  # a hash that collides must not change the groups
        got = X.exact_dedup(make_docs(rows), hash128=weak).collect()
        texts = {}
        for i, t, _, _ in rows:
            texts.setdefault(i, WS.sub("", t or ""))
        assert len(got) == len(rows)
        for r in got:
            assert (r["keep_id"], r["group_size"]) == want[texts[r["doc_id"]]]
            assert r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    kept = X.drop_copies(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 6, 7, 7, 8]
    assert X.exact_dedup(make_docs([])).count() == 0


def brute_near(rows, k, percent):
    sets, ids = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = ({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or {tuple(w)}) if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in keys}


def near_copies():
    """A base with copies of one to forty changed words: many pairs link, many do not."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, i = [], 0
    for length in (3, 9, 40, 150):
        base = [word() for _ in range(length)]
        for edits in [0, 0, 1, 1, 2, 3, 4, 5, 6, 8, 12, 20, 40] * 3:
            t = list(base)
            for _ in range(min(edits, length // 2)):
                t[rng.randrange(len(t))] = word()
            if edits % 3 == 1:
                del t[rng.randrange(len(t))]
            rows.append((i, " ".join(t)))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " "), (i + 3, "the " * 500), (i + 4, "The " * 300)]


def test_near_duplicates(make_docs):
    rows = near_copies()
    df = make_docs([(a, b, None, None) for a, b in rows])
    for k, percent in ((4, 85), (5, 80)):
        got = {r[0]: (r[1], r[2]) for r in J.near_duplicates(df, k=k, percent=percent).collect()}
        assert got == brute_near(rows, k, percent)
    assert J.near_duplicates(make_docs([])).count() == 0


def test_near_duplicates_with_null_and_shared_ids(make_docs):
    words = lambda s, n=60: [f"{s}{i}" for i in range(n)]
    a, b, c = words("a"), words("b"), words("c")
    near = lambda w, *at: " ".join("x" if i in at else x for i, x in enumerate(w))
    rows = [(1, near(a)), (None, near(a).upper()), (None, near(b)), (None, "some clean text of its own"), (None, None),
            (2, near(c)), (3, near(c, 59)), (3, "another text with the same id"), (None, near(b).replace(" ", "  "))]
    kept = J.drop_near_duplicates(make_docs([(i, t, None, None) for i, t in rows])).collect()
    got = [(r["doc_id"], r["text"]) for r in kept]
    assert len([t for i, t in got if t and t.split() == b]) == 1  # of rows without ids one stays
    rest = {x for x in got if not (x[1] and x[1].split() == b)}
    assert rest == {rows[0], rows[3], rows[4], rows[5], rows[7]} and len(got) == 6
    # a class of rows without ids bridges two documents: 7 ~ null ~ 8, but not 7 ~ 8
    chain = [(7, near(a)), (None, near(a, 59)), (8, near(a, 0, 1, 2, 59))]
    assert len({r["component_id"] for r in J.near_duplicates(make_docs([(i, t, None, None) for i, t in chain[::2]]), k=5, percent=88).collect()}) == 2
    assert {r["component_id"] for r in J.near_duplicates(make_docs([(i, t, None, None) for i, t in chain]), k=5, percent=88).collect()} == {7}


def test_signatures_of_linked_sets_meet():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7, 20, 55, 140, 400):
        for _ in range(60):
            t = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            d = int(0.15 * n / 1.0)
            u = np.unique(np.concatenate([t[rng.permutation(n)[: n - d // 2]], rng.integers(0, 1 << 63, d // 2).astype(np.uint64)]))
            c = len(np.intersect1d(t, u))
            if 100 * c >= 85 * (len(t) + len(u) - c):
                assert np.intersect1d(J.signatures(t, 85), J.signatures(u, 85)).size


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_suffix(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 2, np.int8)
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                gone[p + 1:p + 101] = 1
            seen.add(raw[p:p + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[gone[1:-1] == 0])
        out[i] = (len(raw), int(gone.sum()), int((np.diff(gone) == 1).sum()), kept)
    return out


def test_substrings(make_docs):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choice("abcdéfg") for _ in range(5)) for _ in range(n))
    passage, long_ = words(40), words(400)
    rows = [(1, words(30) + passage + words(30)), (2, passage), (3, words(10) + passage[5:] + words(3)), (4, None), (5, ""),
            (6, "short"), (7, "ab" * 600), (8, "xab" * 90), (9, long_), (10, long_), (11, long_[:300] + "!" + long_[301:]),
            (12, passage[:99]), (13, "z" + passage[:100]), (14, long_ + long_)]
    got = {r[0]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in S.remove_repeats(make_docs([(a, b, None, None) for a, b in rows])).collect()}
    assert got == brute_suffix(rows)
    assert S.remove_repeats(make_docs([])).count() == 0


def test_difference_cover_merges_all_classes():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, int(rng.integers(100, 170))).astype(np.uint8)) for _ in range(60)]
    texts += [b"q" * k + texts[3][:110] for k in (0, 1, 2, 3, 4)]
    windows = np.array([len(t) - 99 for t in texts])
    got, seen, want = S.repeated_windows(texts, windows), set(), []
    for t in texts:
        for p in range(len(t) - 99):
            want.append(t[p:p + 100] in seen)
            seen.add(t[p:p + 100])
    assert got.tolist() == want and sum(want) > 20


def test_shingles_of_a_large_batch_take_little_memory():
    import tracemalloc

    import pyarrow as pa
    from corpusloom.llm.words import Polynomials

    rng = random.Random(3)
    words = [f"w{i}" for i in range(5_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(3_000)]
    col, n = pa.array(texts), 0
    tracemalloc.start()
    for i, t in J.shingle_sets(col, 5, Polynomials()):
        n += 1
        if i % 500 == 0:
            w = texts[i].split()
            alone = [s for _, s in J.shingle_sets(pa.array([texts[i]]), 5, Polynomials())]
            assert len(t) == len({tuple(w[j:j + 5]) for j in range(len(w) - 4)}) and np.array_equal(t, alone[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and col.nbytes > 4e6 and peak < 30e6

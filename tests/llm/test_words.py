"""Collocations, periodic runs, streaming BPE, and what tells rows apart, against brute force."""
import random
import re
from collections import Counter
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import bpe_stream as B
from corpusloom.llm import collocations as N
from corpusloom.llm import decontaminate as D
from corpusloom.llm import ngram_join as J
from corpusloom.llm import periodic_runs as R
from corpusloom.llm import sanitise as P
from corpusloom.llm import suffix_dedup as S
from corpusloom.llm.words import Polynomials, exact_ids, spans


def brute_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q) and i > s:
                out[s, i + q - s] = min(q, out.get((s, i + q - s), q))
            i += i == s
    return sorted((s, n, q) for (s, n), q in out.items())


unit = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.sampled_from([1, 1, 2, 3, 4, 5, 7, 12]))
document = st.lists(unit, max_size=6).map(lambda us: [x for u, k in us for x in u * k])


@given(st.lists(document, max_size=5))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(docs):
    ids = np.array([x for d in docs for x in d], np.int64)
    got = R.runs(ids, np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64))
    assert list(zip(*(a.tolist() for a in got))) == [(i, *r) for i, d in enumerate(docs) for r in brute_runs(d)]


def test_runs_of_long_texts():
    for x, want in ((np.zeros(60_000, np.int64), [(0, 0, 60_000, 1)]), (np.tile(np.arange(9_000), 5), [(0, 0, 45_000, 9_000)])):
        assert [tuple(r) for r in np.array(R.runs(x, np.array([0, len(x)]))).T] == want


def test_find_runs_edges(spark, make_docs):
    rows = [(1, None, None, "s"), (2, "", "en", None), (3, " \t\n", "en", "s"), (4, "a  a\na a\ta a b", "en", "s"), (4, "a  a\na a\ta a b", "en", "s"),
            (None, "x y " * 4, "en", "s"), (6, "a a a a a", "en", "s")]
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.find_runs(make_docs(rows)).collect()}
    assert got == {1: ([], ""), 2: ([], ""), 3: ([], ""), 4: ([(0, 6, 1)], "a b"), None: ([(0, 8, 2)], "x y"), 6: ([], "a a a a a")}
    assert R.find_runs(make_docs(rows)).count() == 7 and R.find_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        R.find_runs(make_docs(rows).withColumnRenamed("size", "runs"))


def test_words_that_share_a_hash_stay_apart():
    data = np.frombuffer(b"ab cd ab e", np.uint8)
    s, e, doc = spans(data, np.array([0, 6, 10]))
    assert doc.tolist() == [0, 0, 1, 1]
    for h in (Polynomials().words(data, s, e), np.zeros(4, np.uint64)):
        ids = exact_ids(data, s, e, h)
        assert ids[0] == ids[2] and len(set(ids.tolist())) == 3


def brute_collocations(rows, min_count, max_words, top, cover):
    f, n = Counter(), Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    inside = lambda p, q: any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2))
    out = []
    for p, a in cand.items():
        if any(len(q) > len(p) and q[0] == p[0] and inside(p, q) and 100 * b >= cover * a for q, b in cand.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), left, right))
    rows, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    words = ["Aa", "b", "c", "é", "d-d", "x\xa0y", "ff"]
    line = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " ! "]) for _ in range(rng.randint(0, 60)))
    rows = [(i, line(), rng.choice(["en", "en", "de", None, "und"]), None) for i in range(120)]
    return rows + [(None, None, "en", None), (5, "", "fr", None), (6, "a b c " * 3000, "it", "s"), rows[0], rows[0]]


def test_collocations_equal_brute_force(spoken, make_docs):
    for min_count, max_words, top, cover in ((10, 3, 2000, 50), (3, 4, 5, 80), (40, 2, 7, 50)):
        got = N.collocations(make_docs(spoken), min_count=min_count, max_words=max_words, top=top, cover_percent=cover)
        assert [tuple(r) for r in got.collect()] == brute_collocations([(r[2], r[1]) for r in spoken], min_count, max_words, top, cover)
    assert N.collocations(make_docs([])).count() == 0 and N.collocations(make_docs([(1, None, None, None)])).count() == 0


def test_clashing_fingerprints_are_told_apart_by_text(spoken, make_docs):
    rows = lambda bits: sorted(map(tuple, N.frequent_phrases(make_docs(spoken), min_count=3, fingerprint_bits=bits).collect()))
    assert rows(6) == rows(64)


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def bpe(request):
    from tokenizers import Tokenizer
    path = f"/opt/tokenizers/{request.param}"
    return Tokenizer.from_file(path), B.load(path)


PARTS = ["a", "e", "th", "ing", "'s", "'re", "’", " ", "\n", "é", "é", "İ", "Σ", "1", "23", "!!", "'", "--", "中", "文", "が", "한", "ᄒ", "ᅡ",
         "😀", "‍", "<|endoftext|>", "<|startof", "text|>", "͸", "\U00011de0", "́", "\xa0", "　", "\t", "x" * 9, "<", "|", "²", "ſ", "՘"]


def test_streaming_bpe_equals_the_library(bpe, monkeypatch):
    tok, spec = bpe
    enc, dec, rng = B.Encoder(spec), B.Decoder(spec), random.Random(1)
    texts = ["", " ", "ab" * 4000, "!" * 3000, "".join(rng.choice("abcdefghinorst") for _ in range(9000))]
    for _ in range(300):
        some = rng.sample(PARTS, rng.randint(1, len(PARTS)))
        texts.append("".join(rng.choice(some) for _ in range(rng.randint(1, 120))))
    for chunk in (B.CHUNK, 200, 17, 8):
        monkeypatch.setattr(B, "CHUNK", chunk)
        for t in texts:
            want = tok.encode(t, add_special_tokens=False).ids
            got = list(chain.from_iterable(enc.encode(t)))
            assert got == want, t
            split = rng.randint(0, len(got))
            assert dec.feed(got[:split]) + dec.feed(got[split:]) + dec.finish() == tok.decode(want, skip_special_tokens=False)


def test_tokens_are_final_after_the_lookahead():
    size = {0: 1, 1: 1, 2: 1}
    # c = ab, d = bc..: (1, 2) can take 1 from (0, 1), which can take 0 from what precedes it
    assert B.lookahead([(0, 1, 3), (1, 2, 4)], size) == 1
    assert B.lookahead([(1, 2, 4), (0, 1, 3)], size) == 2
    rng, tried = np.random.default_rng(2), 0
    for _ in range(200):
        merges, size = [], {i: 1 for i in range(3)}
        strings = {i: (i,) for i in range(3)}
        while len(merges) < 12:
            a, b = (int(x) for x in rng.integers(0, len(strings), 2))
            if strings[a] + strings[b] not in strings.values():
                merges.append((a, b, len(strings)))
                strings[len(strings)] = strings[a] + strings[b]
        rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges)}
        ahead = B.lookahead(merges, size)
        text = [int(x) for x in rng.integers(0, 3, 60)]
        whole, known = B.merge_ids(text, rank), B.merge_ids(text[:40], rank)
        end = 0
        for x, y in zip(whole, known):
            end += len(strings[y])
            if end > 40 - ahead:
                break
            assert x == y
            tried += 1
    assert tried > 100


def test_bpe_frames(spark, bpe, make_docs):
    tok, spec = bpe
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "Hello <|endoftext|> wörld", "en", "s"), (3, "Hello <|endoftext|> wörld", "en", "s"), (None, "x" * 5000, "en", "s")]
    out = B.decode(B.encode(make_docs(rows), spec), spec)
    assert out.columns == ["doc_id", "lang", "source", "size", "ids", "decoded"]
    want = {i: tok.encode(t or "", add_special_tokens=False).ids for i, t, _, _ in rows}
    got = out.collect()
    assert len(got) == 5 and all(r["ids"] == want[r["doc_id"]] and r["decoded"] == tok.decode(r["ids"], skip_special_tokens=False) for r in got)
    assert B.encode(make_docs([]), spec).count() == 0
    assert [r["decoded"] for r in B.decode(spark.createDataFrame([(None,), ([10**9],)], "ids array<int>"), spec).collect()] == ["", ""]


def test_substrings_of_null_and_shared_ids(make_docs):
    passage = " ".join(f"w{i:03d}" for i in range(60))
    other = " ".join(f"v{i:03d}" for i in range(90))
    rows = [(None, passage + " one"), (None, "two " + passage), (None, other), (9, passage), (9, other[:200] + " clean " + other[300:320]), (9, passage)]
    got = sorted((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in S.remove_repeats(make_docs([(i, t, None, None) for i, t in rows])).collect())
    full = len(passage)
    lost = {(n, s, r) for n, s, r in got}
    assert (True, len(other), 0) in lost  # a unique text of no id loses nothing
    assert (False, full, full) in lost and sum(r > 0 for _, s, r in got if s == full) == 2
    nulls = sorted(r for n, s, r in got if n and s == full + 4)
    assert nulls[0] == 0 and full - 1 <= nulls[1] <= full + 1


def test_repeated_rows_do_not_silence_terms(spark, make_docs):
    base = [(i, f"plain words number{i} and more of it", "en", "s") for i in range(30)]
    one = [(100, "write to ann.lee@mail.org about zebracorn matters", "en", "s")]
    terms = lambda rows: {s["start"] for r in P.personal_data(make_docs(rows)).collect() if r["doc_id"] == 100 for s in r["spans"] if s["kind"] == "term"}
    assert terms(base + one) and terms(base + one * 4) == terms(base + one)


def test_items_without_ids_mark_words_only(spark, make_docs):
    bench = spark.createDataFrame([(None, "short item"), (2, "other one")], "item_id long, text string")
    got = {r["doc_id"]: (r["items"], len(r["hit_words"])) for r in D.contamination(make_docs([(1, "a short item", None, None), (2, "other one", None, None)]), bench).collect()}
    assert got == {1: ([], 1), 2: (["2"], 1)}


def test_parities_and_lone_elements_never_drop_a_link():
    rng = np.random.default_rng(8)
    for n in (1, 2, 15, 16, 17, 60, 300, 1500):
        for percent in (80, 85):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            drop = int(n * (100 - percent) / 100)
            b = a[np.sort(rng.permutation(len(a))[: len(a) - drop])]
            if not len(b):
                continue
            p, q = J.parity(a), J.parity(b)
            if len(p) > len(q):
                p = p[: len(q)] ^ p[len(q):]
            assert len(p) == len(q)
            assert np.unpackbits((p ^ q).view(np.uint8)).sum() <= len(a) - len(b)
            several = np.zeros(1 << 10, np.uint64)
            low = b[b < np.uint64(1 << 63)]
            np.bitwise_or.at(several, ((low >> np.uint64(6)) & np.uint64(1023)).astype(np.int64), np.uint64(1) << (low & np.uint64(63)))
            assert J.may_link(a, percent, several) and J.may_link(b, percent, several)

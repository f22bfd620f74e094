"""The other operators: brute force, held-out accuracy, and cases at the edges."""
import math
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from corpusloom.llm import chat_format as C
from corpusloom.llm import decontaminate as D
from corpusloom.llm import language_id as L
from corpusloom.llm import mixing as M
from corpusloom.llm import sanitise as P
from corpusloom.llm import token_counts as K
from corpusloom.llm import toxicity as T
from corpusloom.llm.common import held_out

SF001 = "/root/testdata/sf0.001"


def test_decontamination_edges(spark, make_docs):
    bench = spark.createDataFrame([(1, "A b c d e f g h i j k"), (2, "short Item"), (3, None), (4, "..."), (4, "a b c d e f g h i j")],
                                  "item_id long, text string")
    docs = make_docs([(1, "x a-b c D e f g h i j z", None, None), (2, "a b c d e f g h i", None, None), (3, None, None, None),
                      (4, "the short, item short item", None, None), (5, "", None, None), (6, "É short itemé", None, None)])
    for block in (1, 400_000):  # the results do not depend on the blocks
        got = {r[0]: (r["n_words"], [tuple(x) for x in r["hit_words"]], r["items"])
               for r in D.contamination(docs, bench, block_windows=block).collect()}
        assert got == {1: (12, [(1, 11)], ["1", "4"]), 2: (9, [], []), 3: (0, [], []), 4: (5, [(1, 5)], ["2"]), 5: (0, [], []), 6: (3, [], [])}
        kept = D.drop_contaminated(docs, bench, block_windows=block)
        assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [2, 3, 5, 6]
    assert D.contamination(docs, bench.limit(0)).where("size(items) > 0").count() == 0


def test_toxicity_learns_and_scores_edges(spark, make_docs):
    sf = SF001.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = T.fit(docs, labels, usable=~held_out())
    assert model.score("you pathetic idiot, you worthless moron") > 0.3 > model.score("the tion of the and")
    got = {r[0]: r[1] for r in T.score(make_docs([(1, None, None, None), (2, "", None, None), (2, "", None, None)]), model).collect()}
    assert got[1] == got[2] and 0 <= got[1] <= 1
    assert T.score(make_docs([]), model).count() == 0
    assert T.fit_rows([]).score("x") == 0.5 and T.fit_rows([("a", 1), (None, 1)]).score("x") > 0.5


def test_toxicity_sample_is_8000_rows_and_tasks_choose_the_features(spark, make_docs):
    assert T.SAMPLE_ROWS == 8_000
    ids = spark.range(9_000).withColumnRenamed("id", "doc_id")
    labels = ids.withColumn("toxic", (F.col("doc_id") % 5 == 0).cast("int"))
    assert T.sampled_rows(ids.withColumn("text", F.lit("x")), labels).count() == 8_000
    rng = np.random.default_rng(4)
    some = lambda n: " ".join(f"word{w}" for w in rng.integers(0, 40, n))
    rows = [(i, some(12) + (" grumblewort" if i % 4 == 0 and i % 3 else ""), None, None) for i in range(600)]
    y = {i: int(i % 4 == 0) for i, *_ in rows}
    a = T.fit(make_docs(rows), spark.createDataFrame(list(y.items()), "doc_id long, toxic int"))
    b = T.fit_rows([(t, y[i]) for i, t, _, _ in rows])
    assert a.score("a grumblewort") > 0.5 > a.score("word1")
    for t in ("a grumblewort", "word1 word2", "", "you idiot"):
        assert abs(a.score(t) - b.score(t)) < 1e-3


def test_label_model_trusts_good_voters():
    rng = np.random.default_rng(0)
    y = (rng.random(3000) < 0.2).astype(float)
    vote = lambda hit, false: (rng.random(3000) < np.where(y > 0, hit, false)).astype(float)
    gold = np.where(rng.random(3000) < 0.1, 1 - y, y)  # a tenth of the labels are wrong
    good = [vote(0.7, 0.01) for _ in range(6)]
    post = T.label_model(np.column_stack(good + [good[0]] + [vote(0.3, 0.3)]), gold)
    print(((post > 0.5) == y).mean(), (gold == y).mean())
    assert ((post > 0.5) == y).mean() > (gold == y).mean() + 0.02


def test_mixing_targets_and_order(spark, sample):
    rows = M.mix(sample).collect()
    assert len(rows) == sample.count()
    by = {}
    src = {r["doc_id"]: r["source"] for r in sample.collect()}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        assert r["position"] is None or 0 <= r["position"] <= 1
        assert sum(x["words"] for x in r["readings"]) == r["taken"]
        s = by.setdefault(src[r["doc_id"]], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    names = sorted(by, key=lambda s: (s is None, s or ""))
    total, weight = sum(v[2] for v in by.values()), {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), set(names)
    rest = total
    while left:  # reshare the excess until no target is above its cap
        level = rest / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 3 * by[s][2]]
        for s in over or left:
            target[s] = 3.0 * by[s][2] if over else level * weight[s]
        rest -= sum(target[s] for s in over)
        left = left - set(over) if over else set()
    for s in names:
        assert by[s][1] == pytest.approx(target[s]) and abs(by[s][0] - by[s][1]) <= 0.5
    order = [r["position"] for r in M.training_order(M.mix(sample)).collect()]
    assert order == sorted(order)
    assert M.mix(sample).select("doc_id", "taken").exceptAll(M.mix(sample).select("doc_id", "taken")).count() == 0
    assert M.mix(sample.limit(0)).count() == 0


def brute_base(text):
    out = []
    for kind, rx in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                     ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(rx, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 13 <= len(d) <= 19 and P.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567",
             "+1", "++44 20 7946 0958.", "é", " ", ".", "-", "0" * 9, "0000255.1.2.3", "a@b.c@d.e", "%", "word"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        assert P.base_spans(t) == brute_base(t), t


def test_sanitise_removes_disclosing_terms(make_docs):
    filler = [f"common words everywhere {w} again" for w in ("alpha", "beta", "gamma", "delta", "omega", "sigma")]
    rows = [(1, "Write to Zebulon Quark zq@mail.example.org about common things", None, None),
            (2, "Zebulon was here, ask zq@mail.example.org for words", None, None), (3, None, None, None), (4, "", None, None)]
    rows += [(10 + i, f, None, None) for i, f in enumerate(filler)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in P.personal_data(make_docs(rows)).collect()}
    assert got[1] == [("email", 23, 42), ("term", 9, 16)] and ("term", 0, 7) in got[2] and got[3] == got[4] == []
    assert all(not got[10 + i] for i in range(len(filler)))
    clean = {r[0]: r[1] for r in P.sanitise(make_docs(rows)).collect()}
    assert "Zebulon" not in clean[1] and "<email>" in clean[2] and clean[3] is None and clean[10] == filler[0]
    assert P.personal_data(make_docs([])).count() == 0


def test_one_context_discloses_in_whole_texts(make_docs):
    """An entity of one document discloses its terms; they go wherever they stand, beyond REACH and in other texts."""
    rows = [(1, "Quark " + "common words " * 20 + "Zebulon Quark q@mail.example.org common words Quarks", None, None), (2, "common Zebulon words", None, None)]
    rows += [(10 + i, "common words everywhere", None, None) for i in range(60)] + [(80, None, None, None)]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["action"]) for s in r["spans"]] for r in P.personal_data(make_docs(rows)).collect()}
    at = rows[0][1].index("Zebulon")
    n = len(rows)
    assert np.log(n / 1.5) / np.log(n) >= P.GENERALISE > np.log(n / 2.5) / np.log(n)  # Zebulon stands in two documents
    end = len(rows[0][1])
    mail = rows[0][1].index("q@mail")
    assert got[1] == [("email", mail, mail + 18, "remove"), ("term", 0, 5, "generalise"), ("term", at + 8, at + 13, "generalise"), ("term", end - 6, end, "generalise")]
    assert not any(v for k, v in got.items() if k != 1)
    rows += [(100 + i, "common words everywhere", None, None) for i in range(200)]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term"] for r in P.personal_data(make_docs(rows)).collect()}
    assert got[2] == [(7, 14)] and (at, at + 7) in got[1] and not got[10] and not got[80]


def test_suffix_automaton_accepts_substrings_only():
    s = "abcbcabbac"
    nxt = L.suffix_automaton([ord(c) for c in s])

    def accepts(x):
        at = 0
        for c in x:
            if ord(c) not in nxt[at]:
                return False
            at = nxt[at][ord(c)]
        return True
    subs = {s[i:j] for i in range(len(s)) for j in range(i, len(s) + 1)}
    rng = random.Random(1)
    for _ in range(2000):
        x = "".join(rng.choice("abc") for _ in range(rng.randrange(6)))
        assert accepts(x) == (x in subs)


def test_cross_parsing_counts_longest_matches():
    ref = {"x": "the cat sat on the mat", "y": "der hund und die katze"}
    model = L.Model(ref)
    norm = {k: re.sub(r"[^a-z]+", " ", v) for k, v in ref.items()}
    for text in ("the hund sat", "zzz", "katzekatze the the", "a", "cat, sat!! mat 12 on"):
        t = re.sub(r"[^a-z]+", " ", text)
        want = []
        for k in model.langs:
            i = n = 0
            while i < len(t):
                j = i + 1
                while j <= len(t) and t[i:j] in norm[k]:
                    j += 1
                i, n = max(j - 1, i + 1), n + 1
            want.append(n)
        letters, phrases = model.parse([text])
        assert letters[0] == sum(c.isalpha() for c in t)
        assert all(abs(a - b) <= 1 for a, b in zip(phrases[0].tolist(), want)), (text, phrases, want)


def test_language_held_out_accuracy(spark, make_docs):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = L.fit(docs.where(~held_out()))
    got = L.identify(docs, model).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where(held_out()).where("n_chars > 60").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    odd = make_docs([(1, None, "en", "s"), (2, "12 34 !", "en", "s"), (3, "", None, None), (4, "und der die", None, None)])
    assert [r["lang_pred"] for r in L.identify(odd, model).orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert [r["doc_id"] for r in L.drop_undetermined(odd, model).collect()] == [4]
    empty = L.fit(odd.where("false"))
    assert {r["lang_pred"] for r in L.identify(odd, empty).collect()} == {"und"}


def test_language_model_is_small_until_a_task_lays_it_out():
    import tracemalloc

    from pyspark import cloudpickle

    rng = np.random.default_rng(5)
    letters = np.array([chr(0x4E00 + i) for i in range(600)] + [" "] * 20)
    ref = {lang: "".join(rng.choice(letters, 3_000)) for lang in ("aa", "bb", "cc")}
    tracemalloc.start()
    model = L.Model(ref)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sent = len(cloudpickle.dumps(model))
    laid_out = model.table()
    assert laid_out.nbytes > 20e6 and peak < 10e6 and sent < 2e6
    assert len(cloudpickle.dumps(model)) == sent  # what a task has laid out does not travel
    for k, lang in enumerate(model.langs):  # each automaton reads its own reference as one phrase
        symbols, at, phrases = model.symbols(L._code_points(ref[lang]))[0], int(model.roots[k]), 0
        for c in symbols.tolist():
            v = int(laid_out[at + c])
            at, phrases = v & 0x3FFFFFFF, phrases + (v >> 30)
        assert phrases == 0
    texts = [ref["bb"][100:300], "\u0e01" + ref["cc"][:50] + "\u0e01", ""]
    assert model.predict(texts)[0] == ["bb", "cc", "und"]


@pytest.mark.parametrize("rule", K.RULES)
def test_token_attribution(spark, make_docs, rule):
    enc = K.load_encoder(K.vocabulary_path(spark.sparkContext))
    texts = ["one two\nthree\n\n  four é\nß" + " long" * 300, "", None, "\n\n\n", "plain", "日本語\nテキスト\n"]
    docs = make_docs([(i, t, None, None) for i, t in enumerate(texts)])
    rows = K.token_counts(docs, enc, rule=rule).orderBy("doc_id", "section").collect()
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        ends = enc.token_ends(t or "")
        mine = [r for r in rows if r["doc_id"] == i]
        assert math.isclose(sum(r["tokens"] for r in mine), len(ends)) and all(r["doc_tokens"] == len(ends) for r in mine)
        lines, at, want = (t or "").splitlines(keepends=True), 0, []
        for line in lines:
            a, b = at, at + len(line.encode())
            at = b
            want.append((a, b))
        count = [0.0] * len(want)
        for s, e in zip([0, *ends[:-1]], ends):
            part = [max(0, min(e, b) - max(s, a)) for a, b in want]
            if rule == "split":
                for k, x in enumerate(part):
                    count[k] += x / (e - s)
            else:
                k = next(k for k, x in enumerate(part) if x) if rule == "start" else part.index(max(part))
                count[k] += 1
        if lines:
            assert [pytest.approx(r["tokens"]) for r in mine] == count
            assert "".join((t or "")[r["start"]:r["end"]] for r in mine) == t
        else:
            assert len(mine) == 1 and mine[0]["section"] is None
        assert raw.decode() == (t or "")


def test_token_sections_with_gaps(spark):
    enc = K.load_encoder(K.vocabulary_path(spark.sparkContext))
    df = spark.createDataFrame([(1, "é title, the body", [("title", 0, 7), ("body", 9, 17)]), (2, "x", None)],
                               "doc_id long, text string, parts array<struct<name:string,start:long,end:long>>")
    rows = K.token_counts(df, enc, sections_col="parts").orderBy("doc_id", "section").collect()
    assert [r["name"] for r in rows] == ["title", "body", None]
    assert sum(r["tokens"] for r in rows[:2]) <= rows[0]["doc_tokens"] and rows[2]["tokens"] == 1


def test_chat_pairs(spark):
    turn = "array<struct<role:string,text:string>>"
    u, a, b = ("user", "hi"), ("assistant", "hello"), ("assistant", "go")
    df = spark.createDataFrame([(1, [u, a], [u, b]), (2, [u, a], [u, a]), (3, [u], [u, a, u]), (4, None, [b]), (5, [a], [u])],
                               f"pair_id long, chosen {turn}, rejected {turn}")
    got = {r["pair_id"]: r for r in C.format_pairs(df).collect()}
    assert [got[i]["n_prefix"] for i in range(1, 6)] == [1, 2, 1, 0, 0]
    r = got[1]
    assert r["prompt"] == "<|user|>\nhi<|end|>\n" and r["chosen"] == "<|assistant|>\nhello<|end|>\n"
    for side, mask, said in (("chosen", "chosen_mask", "hello"), ("rejected", "rejected_mask", "go")):
        assert [r[side][s["start"]:s["end"]] for s in r[mask]] == [said + "<|end|>\n"]
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[3]["chosen"] == "" and got[4]["chosen_mask"] == []
    turns = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, None, "q"), (1, 1, "assistant", None), (None, 0, "user", "x")],
                                  "conv_id long, turn long, role string, text string")
    conv = {r["conv"]: [tuple(t) for t in r["turns"]] for r in C.gather_turns(turns).collect()}
    assert conv == {1: [("", "q"), ("assistant", ""), ("assistant", "")], None: [("user", "x")]}

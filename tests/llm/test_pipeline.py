"""The pipeline on fixtures, stage by stage against plain Python."""
import corpus_pipeline as P
from corpusloom.llm.common import table
from test_dedup import brute_exact, brute_near

SF001 = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark, sample):
    from corpusloom.llm import decontaminate as D
    stages = dict(P.STAGES)
    one = stages["language_id"](spark, sample, SF001)
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    ids = {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in one.collect()} == ids and one.columns == sample.columns
    two = stages["exact_dedup"](spark, one, SF001)
    ids = {k for k, _ in brute_exact([(i, texts[i]) for i in ids]).values()}
    assert {r["doc_id"] for r in two.collect()} == ids and two.columns == sample.columns
    three = stages["ngram_join"](spark, two, SF001)
    ids = {i for i, (_, c) in brute_near([(i, texts[i]) for i in ids], 5, 80).items() if i == c}
    assert {r["doc_id"] for r in three.collect()} == ids and three.columns == sample.columns
    four = stages["decontamination"](spark, three, SF001)
    bench = [w for r in table(spark, SF001, "benchmark").collect() for w in D.item_windows(D.words(r["text"]))]
    ids = {i for i in ids if not any(b" " + b" ".join(w) + b" " in b" " + b" ".join(D.words(texts[i])) + b" " for w in bench)}
    assert {r["doc_id"] for r in four.collect()} == ids
    five = stages["mixing"](spark, four, SF001).collect()
    assert {r["doc_id"] for r in five} <= ids and [r["position"] for r in five] == sorted(r["position"] for r in five)


def test_repeated_rows_and_shared_ids_are_read_once(spark, make_docs):
    rows = [(7, "c d", "en", "s"), (7, "c d", "en", "s"), (7, "c  d", "en", "s"), (None, "e f g", "en", "s"), (None, "e f g", "en", "s"),
            (5, "one two three", "en", "s"), (5, "six seven eight", "en", "s"), (None, "cd", "en", "s"), (1, "h", "en", "s")]
    one = dict(P.STAGES)["exact_dedup"](spark, make_docs(rows), SF001)
    want = sorted([(7, "c  d"), (None, "e f g"), (5, "one two three"), (5, "six seven eight"), (1, "h")], key=str)
    assert sorted([(r["doc_id"], r["text"]) for r in one.collect()], key=str) == want and one.columns == make_docs(rows).columns
    out = dict(P.STAGES)["mixing"](spark, one, SF001).collect()
    assert len({(r["doc_id"], r["text"], r["reading"]) for r in out}) == len(out) == len({r["position"] for r in out})
    assert sorted({(r["doc_id"], r["text"]) for r in out}, key=str) == want
    assert sum(r["words"] for r in out) == 12 * len({r["reading"] for r in out})


def test_run_and_empty_table(spark, sample):
    assert P.run(spark, SF001).count() > 100
    docs = sample.limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0

import pytest

from corpusloom.operators import chars as C
from corpusloom.operators import sequence as S

EDGE = ["", "x", "😀 emoji", "nb sp", "ideo　space", "zw​sp", "fs\u001csep", "crlf\r\n", "<unk>"]


def test_vocab_encode_decode_roundtrip(spark):
    df = spark.createDataFrame(list(enumerate(EDGE)), "doc_id long, text string")
    vocab = C.char_vocab(df, terminator="\n")
    toks = [r["token"] for r in vocab.orderBy("id").collect()]
    assert toks == sorted(set("".join(t + "\n" for t in EDGE)))
    enc = C.char_encode(S.pack_chars(df), vocab)
    dec = {r["doc_id"]: r["text"] for r in C.char_decode(enc, vocab).collect()}
    assert all(dec[i] == t + "\n" for i, t in enumerate(EDGE))


def test_unknown_char(spark):
    vocab = spark.createDataFrame([(0, "a")], "id int, token string")
    df = S.pack_chars(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), terminator=None)
    with pytest.raises(Exception):
        C.char_encode(df, vocab).collect()
    assert C.char_encode(df, vocab, on_unknown="drop").count() == 1


def test_listing(spark):
    v = spark.createDataFrame([(0, "<unk>"), (1, "<s>"), (2, "a")], "id int, token string")
    got = [r["type"] for r in C.vocab_listing(v, special=["<s>"]).orderBy("id").collect()]
    assert got == ["UNKNOWN", "CONTROL", "NORMAL"]
    assert C.special_ids(v).first().asDict() == {"unk_id": 0, "bos_id": 0, "eos_id": 0}


def test_decode_shuffles_runs_and_orders_keys_that_came_twice(spark):
    from corpusloom.operators import chars as C
    texts = [(1, "a 😀 long enough text, " * 700), (2, ""), (2, "bd"), (2, "acx"), (None, "né"), (3, "one")]
    vocab = C.char_vocab(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    vocab = spark.createDataFrame([*[(r["id"], r["token"]) for r in vocab], (900, "two"), (901, "")], "id int, token string")
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    rows = [(k, i, ids[c]) for k, t in texts for i, c in enumerate(t)] + [(4, 1, 900), (4, 0, ids["o"]), (4, 2, 901), (4, 3, None), (5, 0, 12345)]
    out = C.char_decode(spark.createDataFrame(rows, "doc_id long, pos int, id int").coalesce(1), vocab)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: texts[0][1], 2: "abcdx", None: "né", 3: "one", 4: "otwo", 5: ""}
    mixed = C.char_decode(spark.createDataFrame(rows, "doc_id long, pos int, id int").repartition(5), vocab)
    assert {r["doc_id"]: r["text"] for r in mixed.collect()} == got
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.split("collect_list")[-1]  # rows are joined below the first aggregate

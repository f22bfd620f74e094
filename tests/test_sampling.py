import pytest
from pyspark.sql import functions as F

from corpusloom.operators import sampling as SM


def _dist(spark):
    rows = [("c", 0, 1.0), ("c", 1, 3.0), ("c", 2, 3.0), ("c", 3, 2.0), ("d", 0, 0.5), ("d", 1, 0.5)]
    return spark.createDataFrame(rows, "cid string, id int, logit double")


def test_top_k_keeps_ties(spark):
    d = _dist(spark)
    got = sorted((r["cid"], r["id"]) for r in SM.top_k(d, ["cid"], 1).collect())
    assert got == [("c", 1), ("c", 2), ("d", 0), ("d", 1)]
    assert SM.top_k(d, ["cid"], 99).count() == 6
    assert SM.top_k(d, ["cid"], 0).count() == 6
    assert sorted(r["id"] for r in SM.top_k(d, ["cid"], 3).filter("cid='c'").collect()) == [1, 2, 3]


def test_softmax_greedy_draw(spark):
    d = _dist(spark)
    s = SM.softmax(d, ["cid"]).groupBy("cid").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in s)
    g = {r["cid"]: r["id"] for r in SM.greedy(d, ["cid"]).collect()}
    assert g == {"c": 1, "d": 0}
    p = SM.softmax(d, ["cid"])
    assert {r["cid"]: r["id"] for r in SM.draw(p, ["cid"], F.lit(0.0)).collect()} == {"c": 0, "d": 0}
    assert {r["cid"]: r["id"] for r in SM.draw(p, ["cid"], F.lit(0.999999999)).collect()} == {"c": 3, "d": 1}
    t = SM.temper(d, 2.0).filter("cid='c' and id=1").first()["logit"]
    assert t == 1.5
    assert SM.temper(d, 0.0).filter("cid='c' and id=1").first()["logit"] == 3.0


def test_normalize_requests(spark):
    bodies = [(1, ""), (2, "{}"), (3, '{"prompt": "hi", "temperature": 0, "top_k": 5, "max_new_tokens": 9999}'),
              (4, '{"max_new_tokens": -3}'), (5, '{"temperature": null}'), (6, '{"top_k": "x"}'),
              (7, "not json"), (8, '{"prompt": ""}')]
    df = spark.createDataFrame(bodies, "req_id long, body string")
    r = {x["req_id"]: x.asDict() for x in SM.normalize_requests(df).collect()}
    assert r[1]["prompt"] == "\n" and r[1]["temperature"] == 0.8 and r[1]["top_k"] == 40
    assert r[1]["max_new_tokens"] == 240 and not r[1]["bad"]
    assert r[3]["prompt"] == "hi" and r[3]["temperature"] == 0.0 and r[3]["max_new_tokens"] == 600
    assert r[4]["max_new_tokens"] == 1
    assert r[5]["bad"] and r[6]["bad"] and r[7]["bad"]
    assert r[8]["prompt"] == "\n"
    pytest.importorskip("pandas")

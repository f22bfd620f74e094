"""Request bodies of every JSON kind."""
from corpusloom.operators.sampling import normalize_requests


def test_bodies(spark):
    bodies = {
        '{"top_k": 3.7}': ("top_k", 3), '{"max_new_tokens": 100.0}': ("max_new_tokens", 100), '{"max_new_tokens": 1e2}': ("max_new_tokens", 100),
        '{"max_new_tokens": true}': ("max_new_tokens", 1), '{"top_k": "12"}': ("top_k", 12), '{"temperature": "0.5"}': ("temperature", 0.5),
        '{"temperature": 2}': ("temperature", 2.0), '{"max_new_tokens": 9999}': ("max_new_tokens", 600), '{"max_new_tokens": -3}': ("max_new_tokens", 1),
        "": ("top_k", 40), '{"prompt": "x"}': ("prompt", "x"),
        '{"top_k": "3.5"}': None, '{"top_k": null}': None, '{"prompt": 5}': None, '{"prompt": {"a": 1}}': None, "  ": None,
        "[1]": None, '{"top_k": 3': None, '{"top_k": [1]}': None, "7": None,
    }
    keys = list(bodies)
    df = spark.createDataFrame(list(enumerate(keys)), "req_id long, body string")
    for r in normalize_requests(df).collect():
        want = bodies[keys[r["req_id"]]]
        assert r["bad"] == (want is None), (keys[r["req_id"]], r)
        if want:
            assert r[want[0]] == want[1], keys[r["req_id"]]

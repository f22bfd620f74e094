"""Registered queries against their SQL, whole, at the smallest scale."""
import duckdb
import pytest

from corpusloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect(config={"temp_directory": ""})
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(plain(r[c])) for c in cols) for r in df.collect())
    want = sorted(tuple(str(plain(x)) for x in r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall())
    assert got == want


def test_all_operators_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES

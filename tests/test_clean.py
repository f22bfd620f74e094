"""B1-B6 against the same fixed patterns run by Python's own regex engine."""
import re

import pytest

from corpusloom.functions import clean as CL
from corpusloom.operators.corpus import assemble_corpus, work_report

PY_START = re.compile(CL.START_MARKER, re.S)
PY_END = re.compile(CL.END_MARKER, re.S)
PY_CREDIT = re.compile(CL.CREDIT, re.S)
PY_NOTE = re.compile(CL.NOTE, re.S)


def py_clean(t):
    t = PY_START.split(t, 1)[-1]
    t = PY_END.split(t, 1)[0]
    return PY_NOTE.sub("", PY_CREDIT.sub("", t)).strip()


CASES = [
    "*** START OF THE PROJECT GUTENBERG EBOOK X ***\nbody\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\nlic",
    "no markers at all",
    "head *** START OF THIS PROJECT GUTENBERG EBOOK Y\nspans lines *** text",
    "*** START OF THE PROJECT GUTENBERG EBOOK A ***one*** START OF THE PROJECT GUTENBERG EBOOK B ***two",
    "Produced by someone\nkeep this",
    "Produced by X at www.pgdp.net tail of line\n(This file was\nmade from scans)\nrest",
    "Produced by X at pgdp.net (This file opens\nand closes) after",
    "text then Produced by hand",
    "a [Illustration: a [b] c] d",
    "a [Illustrations] b [Transcriber's Note: x] c [  Illustration] d",
    "[illustration lower case] kept",
    " 　 padded ​\u001c\u001f\t\n",
    "\u0085 x  ",
    "",
    "   ",
]


@pytest.mark.parametrize("text", CASES)
def test_strip_boilerplate_matches_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(CL.strip_boilerplate(df["t"]).alias("b")).first()["b"]
    assert got == py_clean(text)


def test_each_step(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "t string")
    from pyspark.sql import functions as F
    rows = df.select(CL.after_start(F.col("t")).alias("a"), CL.before_end(F.col("t")).alias("b"),
                     CL.drop_credits(F.col("t")).alias("c"), CL.drop_notes(F.col("t")).alias("d"),
                     CL.strip_ws(F.col("t")).alias("e"), "t").collect()
    for r in rows:
        t = r["t"]
        assert r["a"] == PY_START.split(t, 1)[-1]
        assert r["b"] == PY_END.split(t, 1)[0]
        assert r["c"] == PY_CREDIT.sub("", t)
        assert r["d"] == PY_NOTE.sub("", t)
        assert r["e"] == t.strip()


def test_normalize_newlines(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n\r\n",)], "t string")
    assert df.select(CL.normalize_newlines(df["t"])).first()[0] == "a\nb\nc\n\n"


def test_assemble_and_report(spark):
    rows = [(1, 10, 1, "alpha"), (1, 10, 2, "beta"), (2, 20, 5, "gamma"), (3, 30, 7, "")]
    p = spark.createDataFrame(rows, "ord int, work_id long, doc_id long, body string")
    got = {r["doc_id"]: (r["text"], r["char_off"]) for r in assemble_corpus(p, width=1).collect()}
    want = "alpha\nbeta\n\n\ngamma\n\n\n\n"
    assert "".join(got[d][0] for d in sorted(got)) == want
    off = 0
    for d in sorted(got):
        assert got[d][1] == off
        off += len(got[d][0])
    rep = {r["title"]: r["chars"] for r in work_report(p.withColumn("title", p["work_id"].cast("string"))).collect()}
    assert rep == {"10": 9, "20": 5, "30": 0, None: 14}

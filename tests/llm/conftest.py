import pytest
from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("size", T.IntegerType())])  # "size" clashes with names the operators use


@pytest.fixture
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, l, s, 1) for i, t, l, s in rows], DOC)
    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the smallest scale, with nulls, empty, repeated and long texts added."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    text = docs.orderBy("doc_id").first()["text"]
    extra = spark.createDataFrame([(9001, None, None, None, 0), (9002, "", "en", None, 0), (9003, " \t\n", "en", "src0", 3),
                                   (9004, text, "en", "src1", len(text)), (9005, text + " tail", "en", "src1", 0),
                                   (9006, "aaaa " * 4000, "en", "src0", 0), (9007, "one two", "de", "src2", 7)], docs.schema)
    return docs.unionByName(extra).cache()

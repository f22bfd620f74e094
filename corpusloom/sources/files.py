"""Text sources and the corpus sink (A1-A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.clean import normalize_newlines


def read_works(spark: SparkSession, path: str, works: DataFrame,
               id_pattern: str = r"(\d+)[^/]*$") -> DataFrame:
    """A1: one UTF-8 text per file (whole file as one row), its work id parsed
    from the file name, joined to ``works(work_id, title, ord)``.

    Returns ``(work_id, title, ord, text)``.  Files whose name holds no known
    work id are no works.  A work without a file fails the job by its title.
    """
    raw = (spark.read.text(path, wholetext=True)
           .select(F.regexp_extract(F.input_file_name(), id_pattern, 1).try_cast("bigint").alias("work_id"),
                   F.col("value").alias("text"), F.lit(True).alias("__found")))
    text = F.when(F.col("__found"), F.col("text")).otherwise(
        F.raise_error(F.concat(F.lit("no file for work "), F.col("work_id").cast("string"), F.lit(": "),
                               F.coalesce("title", F.lit("")))))
    return (works.join(raw, "work_id", "left")
            .select("work_id", "title", "ord", text.alias("text")))


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet",
                   text_col: str = "text", normalize: bool = True) -> DataFrame:
    """A2: training text from Parquet (``doc_id, text``) or plain text files (one
    document per file).  ``normalize`` applies text-mode newline handling
    (``\\r\\n`` / ``\\r`` -> ``\\n``), as the trainer's reader does; the corpus
    builder does not, so pass ``normalize=False`` to count like it."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "text":
        raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("__file"), F.col("value").alias(text_col))
        # ids in the order of the file names: the list of files is small beside their texts
        ids = raw.select("__file").distinct().withColumn("doc_id", F.row_number().over(W.orderBy("__file")).cast("bigint") - 1)
        df = raw.join(ids, "__file").select("doc_id", text_col)
    else:
        raise ValueError(fmt)
    if normalize:
        df = df.withColumn(text_col, normalize_newlines(F.col(text_col)))
    return df


def write_corpus(corpus: DataFrame, path: str, partitions: int | None = None) -> None:
    """A3: write the corpus in order: range-partitioned on (ord, doc_id) (the
    sampled ranges split a large work across files) and sorted inside each
    file, so reading files in name order yields corpus order."""
    n = partitions or corpus.sparkSession.sparkContext.defaultParallelism
    (corpus.repartitionByRange(n, "ord", "doc_id")
     .sortWithinPartitions("ord", "doc_id")
     .write.mode("overwrite").parquet(path))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

"""Cutting lineage: tables in the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from corpusloom.session import checkpoint_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go with the job that made them


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back; it survives lost executors.

    The shuffle files of the writing job, which the table replaces, are dropped at its end.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes ``stored`` tables whose readers have been stored themselves."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(conf).delete(path, True)
